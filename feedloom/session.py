"""Session helpers: table loading, lineage cuts and a few guards shared by the operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only a local session may do without: it gets a private one, as
    in tests; on a cluster a folder of one machine would lose what other machines wrote, so that is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not named and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "feedloom-checkpoints"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage, so that a lost executor costs no recomputation chain."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give the package to the executors, once for each application: they may share no file system with the driver."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_feedloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "feedloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("feedloom", os.path.relpath(full, package)))
    sc.addPyFile(path)
    sc._feedloom_shipped = True

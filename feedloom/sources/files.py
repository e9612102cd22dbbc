"""JSON, JSONL, XML and versioned snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_items(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Items from a JSON array or from lines; which one, the first character tells."""
    first = spark.read.text(path).select(F.substring(F.trim("value"), 1, 1).alias("c")).filter("c != ''").limit(1).collect()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=bool(first) and first[0].c == "[")


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """The counters of a run, one row, as one JSON file."""
    df.limit(1).coalesce(1).write.mode("overwrite").json(path)


def as_array(df: DataFrame, order: str) -> DataFrame:
    """One row with all rows as a JSON array, in order: for export of a bounded result."""
    return df.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*df.columns).alias("row")))), lambda x: x["row"])).alias("json"))


def xml_to_csv(spark: SparkSession, source: str, row_tag: str, target: str) -> None:
    spark.read.format("xml").option("rowTag", row_tag).load(source).write.mode("overwrite").csv(target, header=True)


def feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """The feeds of a list: one URL a line, without blanks and ``#`` lines."""
    return spark.read.text(path).select(F.trim("value").alias("url")).filter("url != '' and not startswith(url, '#')")


class Snapshots:
    """A table as versions in directories of a shared folder; readers see the version that was named last."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def current(self) -> str | None:
        fs, path = self._fs()
        at = path(self.root + "/CURRENT")
        if not fs.exists(at):
            return None
        return self.spark.read.text(self.root + "/CURRENT").first().value

    def read(self, schema: str) -> DataFrame:
        version = self.current()
        return self.spark.read.schema(schema).parquet(version) if version else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame) -> str:
        """Write the next version, then name it: a failure leaves the old one."""
        target = f"{self.root}/v-{uuid.uuid4().hex}"
        df.write.parquet(target)
        fs, path = self._fs()
        out = fs.create(path(self.root + "/CURRENT.new"), True)
        out.write(bytearray(target.encode()))
        out.close()
        fs.delete(path(self.root + "/CURRENT"), False)
        fs.rename(path(self.root + "/CURRENT.new"), path(self.root + "/CURRENT"))
        return target

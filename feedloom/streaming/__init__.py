"""Extensions on Structured Streaming: novelty by micro-batch and windowed counts with watermarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, at: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by key and tumbling window; later rows than the watermark are dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


class SeenKeys:
    """The keys that a stream has passed on: one folder for each micro-batch under a shared path, so that a batch adds its
    new keys only, and one that runs again after a failure replaces its own."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str = "string"):
        self.spark, self.path, self.key, self.kind = spark, path.rstrip("/"), key, kind

    def before(self, number: int) -> DataFrame:
        """The keys of all batches but ``number``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], f"{self.key} {self.kind}")
        return self.spark.read.schema(f"{self.key} {self.kind}, batch bigint").parquet(self.path).filter(F.col("batch") != number).select(self.key)

    def add(self, new: DataFrame, number: int) -> None:
        new.select(self.key).write.mode("overwrite").parquet(f"{self.path}/batch={number}")


def novelty_stream(items: DataFrame, key: str, seen: SeenKeys, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Each micro-batch is compared with the keys of the other ones; new rows go to ``sink`` with the number of their batch, then
    their keys are added.  A batch that runs again after a failure gives the same rows under the same number, so that a
    sink that replaces by number holds every row once."""

    def batch(df: DataFrame, number: int) -> None:
        new = df.filter(F.col(key).isNotNull()).dropDuplicates([key]).join(seen.before(number), key, "left_anti").persist()
        try:
            sink(new, number)
            seen.add(new, number)
        finally:
            new.unpersist()

    return items.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

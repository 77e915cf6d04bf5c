"""State kept as written tables, one folder per micro-batch.

A micro-batch that runs again overwrites its own folder and reads the folders before
it, so a restart gives the same result as an undisturbed run. Folders lie in shared
storage and survive lost executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


class BatchTable:
    """A table whose versions or increments are the micro-batches."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def write(self, rows: DataFrame, batch: int, by: str | None = None) -> None:
        """``by`` is a column whose values get folders of their own within the batch."""
        out = rows.write.mode("overwrite")
        (out.partitionBy(by) if by else out).parquet(f"{self.path}/batch={batch}")

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def previous(self, batch: int) -> DataFrame:
        """The version the preceding micro-batch left behind."""
        if batch == 0:
            return self.empty()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch - 1}")

    def before(self, batch: int, by: str | None = None, only: list | None = None) -> DataFrame:
        """All increments of earlier micro-batches, or only those in some folders of ``by``."""
        if batch == 0:
            return self.empty()
        rows = (self.spark.read.schema(f"{self.schema}, batch BIGINT")
                .option("basePath", self.path).parquet(f"{self.path}/batch=*"))
        rows = rows.where(F.col("batch") < batch).drop("batch")
        return rows if by is None else rows.where(F.col(by).isin(only or []))

    def read(self) -> DataFrame:
        return (self.spark.read.schema(self.schema).option("basePath", self.path)
                .parquet(f"{self.path}/batch=*"))


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None],
                checkpoint: str) -> StreamingQuery:
    """Process what is available, micro-batch by micro-batch, then stop."""
    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

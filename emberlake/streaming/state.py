"""State of a ``foreachBatch`` job as a table with a partition per micro-batch.

A micro-batch reads the newest partition of an epoch below its own and writes
its own partition, so a retried micro-batch starts from the same state and
replaces what it had written.  The two newest partitions are kept: the newest
may belong to a micro-batch that is not committed and will be retried.  Every
epoch's rows include a marker row, so that no partition is ever empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "epoch="


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions of ``columns`` that ``df`` has rows for."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*columns).parquet(path))


def interval_micros(spark: SparkSession, text: str) -> int:
    """The micros of an interval such as ``10 minutes``."""
    at = "TIMESTAMP_NTZ '2000-01-01 00:00:00'"
    return int(spark.sql(f"SELECT timestampdiff(MICROSECOND, {at}, {at} + INTERVAL {text}) AS n").first().n)


class EpochTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _folder(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def epochs(self) -> list[int]:
        fs, path = self._folder()
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
        return sorted(int(n[len(PREFIX):]) for n in names if n.startswith(PREFIX))

    def before(self, epoch: int) -> DataFrame:
        """The rows that the newest epoch below ``epoch`` left; none at first."""
        older = [e for e in self.epochs() if e < epoch]
        if not older:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{PREFIX}{older[-1]}")

    def write(self, rows: DataFrame, epoch: int) -> None:
        """Write the state of ``epoch`` and drop what no retry can need."""
        overwrite_partitions(rows.withColumn("epoch", F.lit(epoch).cast("long")), self.path, "epoch")
        for old in [e for e in self.epochs() if e <= epoch][:-2]:
            self._drop(old)

    def drop_below(self, epoch: int) -> None:
        """Drop the partitions of all epochs below ``epoch``."""
        for old in [e for e in self.epochs() if e < epoch]:
            self._drop(old)

    def _drop(self, epoch: int) -> None:
        fs, path = self._folder(f"{PREFIX}{epoch}")
        fs.delete(path, True)

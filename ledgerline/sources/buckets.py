"""Tables in buckets of a key, of which a batch rewrites those that it touches.

The bucket is a partition column, a hash of the key columns modulo the number of buckets. A batch reads the
touched buckets only (partition pruning), merges, and overwrites them by Spark's dynamic
partition overwrite; the files of all other buckets stay as they are. What is merged is staged first, as
a complete table inside the target's folder that readers don't see. If a run dies while buckets are
being replaced, the next one finds the staged table and replaces them again before it does anything else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import written
from ledgerline.sources.sinks import insert_new, replace_groups, upsert

COLUMN = "bucket"
_STAGED = "_staged"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class BucketTable:
    """A table at `path`, dealt by the columns `by`; both are fixed once it has rows, and so is `buckets`."""

    path: str
    by: tuple[str, ...]
    buckets: int = 64

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn(COLUMN, F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int"))

    def _fs(self, spark: SparkSession, *names: str):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *names]))
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def exists(self, spark: SparkSession) -> bool:
        fs, buckets = self._fs(spark, f"{COLUMN}=*")
        return bool(len(fs.globStatus(buckets) or ()))

    def read(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; the others aren't read."""
        df = spark.read.parquet(self.path)
        return (df if buckets is None else df.filter(F.col(COLUMN).isin(*buckets))).drop(COLUMN)

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's rows: at most self.buckets numbers."""
        return sorted(r[0] for r in self.with_bucket(batch).select(COLUMN).distinct().collect())

    def recover(self, spark: SparkSession) -> None:
        """Ends a replacement that a run did not: a staged table is complete once its _SUCCESS is there."""
        fs, staged = self._fs(spark, _STAGED)
        if fs.exists(self._fs(spark, _STAGED, "_SUCCESS")[1]):
            self._publish(spark)
        elif fs.exists(staged):
            fs.delete(staged, True)

    def _publish(self, spark: SparkSession) -> None:
        fs, staged = self._fs(spark, _STAGED)
        merged = spark.read.parquet(str(staged))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(COLUMN).parquet(self.path)
        fs.delete(staged, True)

    def apply(self, batch: DataFrame, merge: Merge) -> list[int]:
        """Replaces the touched buckets by merge(their rows, batch); returns them."""
        spark = batch.sparkSession
        self.recover(spark)
        batch = written(batch)  # it decides which buckets are read, and is merged
        touched = self.touched(batch)
        if touched:
            existing = self.read(spark, touched) if self.exists(spark) else batch.limit(0)
            # about a file a bucket; larger ones are split
            merged = self.with_bucket(merge(existing, batch)).hint("rebalance", COLUMN)
            merged.write.partitionBy(COLUMN).parquet(f"{self.path.rstrip('/')}/{_STAGED}")
            self._publish(spark)
        return touched

    def upsert(self, batch: DataFrame, keys: list[str], order: list[str]) -> list[int]:
        """One row for each key, the last by `order` of all batches so far; a batch that comes again or late does no harm."""
        return self.apply(batch, lambda old, new: upsert(old.limit(0), old.unionByName(new, allowMissingColumns=True), keys, order))

    def insert_new(self, batch: DataFrame, keys: list[str], order: list[str]) -> list[int]:
        """Rows whose key is not there yet; among them the first by `order`."""
        return self.apply(batch, lambda old, new: insert_new(old, new, keys, order))

    def replace_groups(self, batch: DataFrame, key: str) -> list[int]:
        """All rows of the batch's values of `key` (one of `by`) are replaced."""
        if self.by != (key,):
            raise ValueError(f"{self.path} is dealt by {self.by}, so the rows of one {key} may lie anywhere")
        return self.apply(batch, lambda old, new: replace_groups(old, new, key))

"""Batch-incremental work: what is left to do, and latest-wins tables fed by a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.buckets import BucketTable


def pending(candidates: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose key is not done yet."""
    return candidates.join(done.select(*keys).distinct(), keys, "left_anti")


def job_states(log: DataFrame) -> DataFrame:
    """job, done, failed, state (ok, partial, failed) and one error of each job's log rows (job, item, error)."""
    made = log.groupBy("job").agg(F.count(F.lit(1)).alias("done"), F.count("error").alias("failed"), F.max("error").alias("error"))
    state = F.when(F.col("failed") == 0, "ok").when(F.col("failed") < F.col("done"), "partial").otherwise("failed")
    return made.withColumn("state", state)


def attempts(log: DataFrame, most: int = 3, waits: tuple[int, ...] = (1, 3, 9)) -> DataFrame:
    """job, item, attempts, state and wait of every item of an attempt log (job, item, attempt from 1, error): ok once an attempt had
    no error; failed after `most` with one; else retry, after so many seconds. An item that fails does not stop its job."""
    made = log.groupBy("job", "item").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("error").isNull()).alias("_ok"), F.max_by("error", "attempt").alias("error"))
    state = F.when(F.col("_ok") > 0, "ok").when(F.col("attempts") >= most, "failed").otherwise("retry")
    pause = F.element_at(F.array(*map(F.lit, waits)), F.least(F.col("attempts"), F.lit(len(waits))).cast("int"))
    return made.withColumn("state", state).withColumns({"wait": F.when(F.col("state") == "retry", pause), "error": F.when(F.col("state") != "ok", F.col("error"))}).drop("_ok")


def attempted_states(log: DataFrame, most: int = 3) -> DataFrame:
    """job, items, ok, failed, waiting and state of each job: done once nothing waits, however many items failed."""
    made = attempts(log, most).groupBy("job").agg(F.count(F.lit(1)).alias("items"), *[F.count_if(F.col("state") == s).alias(n) for s, n in (("ok", "ok"), ("failed", "failed"), ("retry", "waiting"))])
    return made.withColumn("state", F.when(F.col("waiting") > 0, "running").otherwise("done"))


def run_upserts(spark: SparkSession, source: str, schema: str, target: str, keys: list[str], order: list[str], checkpoint: str, buckets: int = 64) -> None:
    """Reads all files that arrived in `source` since the last run and merges them in the table
    `target`, latest wins. Only the buckets of keys that a batch touches are rewritten; a repeated batch changes nothing."""
    table = BucketTable(target, tuple(keys), buckets)
    stream = spark.readStream.schema(schema).json(source)
    stream.writeStream.foreachBatch(lambda batch, _: table.upsert(batch, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

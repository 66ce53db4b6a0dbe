"""The screening interface: range filters, search, sorting, rankings, histograms, limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def screen(df: DataFrame, ranges: dict[str, tuple], search: dict[str, str] | None = None, sort: list[tuple[str, bool]] | None = None, limit: int | None = None) -> DataFrame:
    """Rows inside all ranges (an end may be None) that contain all search texts, whatever their case."""
    for c, (low, high) in ranges.items():
        df = df if low is None else df.filter(F.col(c) >= low)
        df = df if high is None else df.filter(F.col(c) <= high)
    for c, text in (search or {}).items():
        df = df.filter(F.contains(F.lower(F.col(c)), F.lit(text.lower())))
    if sort:
        df = df.orderBy(*[F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in sort])
    return df if limit is None else df.limit(limit)


def top(df: DataFrame, value: str, n: int, key: str, largest: bool = True) -> DataFrame:
    """The n rows of largest (or least) value that have one; the key decides ties."""
    order = F.desc(value) if largest else F.asc(value)
    return df.filter(F.col(value).isNotNull()).orderBy(order, key).limit(n)


def rankings(df: DataFrame, key: str, metrics: list[str], n: int) -> DataFrame:
    """ranking, key, value and rank of the n best of each metric."""
    long = df.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([key], metrics, "ranking", "value").filter("value is not null")
    return long.withColumn("rank", F.row_number().over(W.partitionBy("ranking").orderBy(F.desc("value"), key))).filter(F.col("rank") <= n)


def histogram(df: DataFrame, value: str, low: float, high: float, buckets: int) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def within_limits(df: DataFrame, most: dict[str, float]) -> DataFrame:
    """Adds kept: no value over its limit (a missing value is not over)."""
    over = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > m, F.lit(False)) for c, m in most.items()])
    return df.withColumn("kept", ~over)

"""Joins that the fundamentals pipelines need beyond plain equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import ticker_variants


def unique_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, of which no two have the same keys; the action fails if two have. For sides of a join that may not multiply rows."""
    twice = F.count(F.lit(1)).over(W.partitionBy(*keys)) > 1
    error = F.concat_ws(" ", F.lit(f"several rows of one {', '.join(keys)}:"), *[F.col(k).cast("string") for k in keys])
    return rows.withColumn("_ok", F.when(twice, F.raise_error(error)).otherwise(F.lit(True))).filter("_ok").drop("_ok")


def matched_or_why(left: DataFrame, right: DataFrame, key: str, failed: Column) -> DataFrame:
    """left with right's columns by key, and state: matched, error (right's row failed) or no_row."""
    joined = left.join(right.withColumn("_there", F.lit(True)), key, "left")
    state = F.when(F.col("_there").isNull(), "no_row").when(failed, "error").otherwise("matched")
    return joined.withColumn("state", state).drop("_there")


def variant_join(wanted: DataFrame, catalog: DataFrame, key: str, ticker: str) -> DataFrame:
    """Each wanted row with the catalog row of the first spelling of its ticker that is there."""
    tried = wanted.select(key, ticker, F.posexplode(ticker_variants(ticker)).alias("_pos", "matched_as"))
    hits = tried.join(catalog.withColumnRenamed(ticker, "matched_as"), "matched_as")
    return hits.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy("_pos"))).filter("_rn = 1").drop("_rn", "_pos")


def route_excluded(rows: DataFrame, excluded: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """rows whose key isn't excluded, and the others with excluded's reason."""
    return rows.join(excluded.select(key), key, "left_anti"), rows.join(excluded.select(key, "reason"), key)


def usable_pairs(left: DataFrame, right: DataFrame, key: str, values: tuple[str, str], failed: Column) -> DataFrame:
    """Rows of both sides by key, without failed ones and without a value that is missing or, as the
    reference, zero."""
    a, b = values
    return left.join(right, key).filter(~F.coalesce(failed, F.lit(False)) & F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(b) != 0))


def first_hit(wanted: DataFrame, catalog: DataFrame, key: str, hit: Column, order: list) -> DataFrame:
    """Each wanted row with the first catalog row of its search key that `hit` accepts, or with NULLs."""
    found = wanted.join(catalog, key).filter(hit)
    names = [c for c in catalog.columns if c != key]
    best = found.groupBy(*wanted.columns).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_hit"))
    return wanted.join(best, wanted.columns, "left").select(*wanted.columns, *[F.col("_hit")[c].alias(c) for c in names])


def bounded_scan(rows: DataFrame, by: list[str], order: list, matches: Column, most_matches: int, most_examined: int) -> DataFrame:
    """The matching rows that a scan in order takes, which stops after so many matches or examined rows."""
    at = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = rows.withColumns({"_m": matches}).withColumns({"_examined": F.count(F.lit(1)).over(at), "_matches": F.count_if("_m").over(at)})
    return counted.filter(F.col("_m") & (F.col("_examined") <= most_examined) & (F.col("_matches") <= most_matches)).drop("_m", "_examined", "_matches")


def first_group(rows: DataFrame, key: str, tags: str, members: DataFrame, order: list[str], other: str = "otro") -> DataFrame:
    """rows with group: the first of `order` that has one of the row's tags (an array) among its members (tag, group), else `other`.
    rows are unique by key; members may be of any size."""
    ranks = F.create_map(*[F.lit(x) for k, g in enumerate(order) for x in (g, k)])
    ranked = members.filter(F.col("group").isin(order)).groupBy("tag").agg(F.min(ranks[F.col("group")]).alias("_rank"))
    best = rows.select(key, F.explode(F.array_distinct(tags)).alias("tag")).join(ranked, "tag").groupBy(key).agg(F.min("_rank").alias("_rank"))
    names = F.array(*map(F.lit, order))
    return rows.join(best, key, "left").withColumn("group", F.coalesce(F.try_element_at(names, F.col("_rank") + 1), F.lit(other))).drop("_rank")

"""Where a figure comes from: tag, strategy, period end and source rows, carried through resolution, trailing months and ratios."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import guarded_ratio, safe_ratio
from ledgerline.operators import intervals, periods
from ledgerline.operators.periods import KEYS, TTM, TtmRule

SOURCE = ["value", "end", "strategy", "tag", "rows"]


@dataclass(frozen=True)
class Formula:
    """numerator / denominator; guarded: NULL unless the denominator is positive."""

    numerator: str
    denominator: str
    guarded: bool = False


def sourced_metrics(facts: DataFrame, priorities: DataFrame, resolve: Callable[[DataFrame, DataFrame], DataFrame] = periods.resolve_recent, rule: TtmRule = TTM) -> DataFrame:
    """entity, concept, value, end, strategy, tag, rows: the trailing twelve months of each concept, the tag that stands
    for it, and the seq of the rows that made the value."""
    resolved = resolve(facts, priorities)
    return periods.trailing_twelve_months(periods.latest_filed(resolved), rule, ("tag",), True).select(*KEYS, *SOURCE)


def sourced_ratios(metrics: DataFrame, formulas: dict[str, Formula]) -> DataFrame:
    """entity, ratio, value, parts: an array of (concept, value, end, strategy, tag, rows) of its numerator and
    denominator, those that the entity has; stale_end: the older of their ends. One shuffle by entity."""
    used = list(dict.fromkeys(c for f in formulas.values() for c in (f.numerator, f.denominator)))
    part = F.struct("concept", *SOURCE)
    wide = metrics.filter(F.col("concept").isin(used)).groupBy("entity").agg(*[F.first(F.when(F.col("concept") == c, part), ignorenulls=True).alias(f"_{k}") for k, c in enumerate(used)])
    at = lambda c: F.col(f"_{used.index(c)}")
    each = []
    for name, f in formulas.items():
        a, b = at(f.numerator), at(f.denominator)
        value = (guarded_ratio if f.guarded else safe_ratio)(a["value"], b["value"])
        each.append(F.struct(F.lit(name).alias("ratio"), value.alias("value"), F.array_compact(F.array(a, b)).alias("parts"), F.least(a["end"], b["end"]).alias("stale_end")))
    return wide.select("entity", F.inline(F.array(*each)))


def sourced_growth(series: DataFrame, years: int = 5) -> DataFrame:
    """keys, cagr, last, last_end, base, base_end of an annual series; NULL growth unless both are positive."""
    ranked = series.withColumn("_rn", F.row_number().over(W.partitionBy(*KEYS).orderBy(F.desc("end"))))
    pick = lambda n: F.max(F.when(F.col("_rn") == n, F.struct("val", "end")))
    made = ranked.groupBy(*KEYS).agg(pick(1).alias("l"), pick(years + 1).alias("b"))
    growth = F.when((F.col("l.val") > 0) & (F.col("b.val") > 0), F.pow(F.col("l.val").cast("double") / F.col("b.val").cast("double"), F.lit(1.0 / years)) - 1)
    return made.select(*KEYS, growth.alias("cagr"), F.col("l.val").alias("last"), F.col("l.end").alias("last_end"), F.col("b.val").alias("base"), F.col("b.end").alias("base_end"))


def sourced_balance(facts: DataFrame) -> DataFrame:
    """keys, average, current, current_end, previous, previous_end: the last balance and the one about a year older."""
    every = intervals.earlier_balances(facts)
    last = every.groupBy(*KEYS).agg(F.max_by(F.struct("val", "end", "prior", "prior_end"), F.struct("end", -F.col("seq"))).alias("_l"))
    average = F.coalesce((F.col("_l.val") + F.col("_l.prior")) / 2, F.col("_l.val"))
    return last.select(*KEYS, average.alias("average"), F.col("_l.val").alias("current"), F.col("_l.end").alias("current_end"), F.col("_l.prior").alias("previous"), F.col("_l.prior_end").alias("previous_end"))

"""Period algebra over facts (entity, concept, seq, start, end, val[, form, filed, fy, tag, unit]).

seq is the order of the source and decides every tie. All windows partition by the keys, so one
shuffle by them serves a whole chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import inclusive_days

KEYS = ["entity", "concept"]
ANNUAL_FORMS = ("10-K", "20-F", "40-F")
# Units in order of preference.
UNITS = ("USD", "USD/shares", "shares", "pure")


def _first(df: DataFrame, by: list[str], *order) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter("_rn = 1").drop("_rn")


def latest_filed(facts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row for each period: the latest filed, the first of those; a missing start is a period of its own."""
    return _first(facts, [*keys, "start", "end"], F.desc_nulls_last("filed"), F.asc("seq"))


def preferred_unit(facts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of each metric's preferred unit among those it has."""
    rank = F.array_position(F.array(*map(F.lit, UNITS)), F.col("unit"))
    ranked = facts.withColumn("_unit", F.when(rank > 0, rank))
    return ranked.withColumn("_best", F.min("_unit").over(W.partitionBy(*keys))).filter("_unit = _best").drop("_unit", "_best")


def resolve_first(facts: DataFrame, priorities: DataFrame) -> DataFrame:
    """For each concept the rows of its first tag (priorities: tag, concept, priority) that has any."""
    named = facts.drop("concept").join(F.broadcast(priorities), "tag")
    return named.withColumn("_best", F.min("priority").over(W.partitionBy(*KEYS))).filter("priority = _best").drop("_best")


def resolve_recent(facts: DataFrame, priorities: DataFrame) -> DataFrame:
    """For each concept the rows of the tag with the latest period; the earlier priority on ties."""
    named = facts.drop("concept").join(F.broadcast(priorities), "tag")
    newest = named.withColumn("_end", F.max("end").over(W.partitionBy(*KEYS, "tag")))
    best = F.max(F.struct(F.col("_end"), -F.col("priority"))).over(W.partitionBy(*KEYS))
    return newest.withColumn("_best", best).filter(F.struct(F.col("_end"), -F.col("priority")) == F.col("_best")).drop("_end", "_best")


def resolve_priority(facts: DataFrame, priorities: DataFrame) -> DataFrame:
    """For each concept the rows of its best listed tag; without a listed one, of its first tag by name.
    facts has a concept of its own, which a tag of any taxonomy may bear."""
    ranked = facts.join(F.broadcast(priorities), ["concept", "tag"], "left")
    best = F.min(F.struct(F.coalesce("priority", F.lit(1 << 30)).alias("p"), F.col("tag"))).over(W.partitionBy(*KEYS))
    return ranked.withColumn("_best", best).filter(F.col("tag") == F.col("_best")["tag"]).drop("_best", "priority")


def elect_scheme(facts: DataFrame, first: str = "us-gaap", second: str = "ifrs-full") -> DataFrame:
    """Rows of each entity's taxonomy: the one with more different concepts, `first` on ties."""
    n = lambda name: F.count_distinct(F.when(F.col("taxonomy") == name, F.col("concept")))
    chosen = facts.groupBy("entity").agg(F.when(n(second) > n(first), second).otherwise(first).alias("taxonomy"))
    return facts.join(chosen, ["entity", "taxonomy"], "left_semi")


@dataclass(frozen=True)
class TtmRule:
    """Days that tell periods apart, and how far matches may be off."""

    quarter: tuple[int, int] = (85, 100)
    annual: tuple[int, int] = (355, 380)
    gap: int = 5
    partial: tuple[int, int] = (-100_000, 300)
    start: int = 7
    prior: tuple[int, int] = (350, 380)
    duration: int = 7
    prior_newest: bool = False


TTM = TtmRule()
#: The older rule: year-to-date partials of 170 to 290 days, closer matches, the newest prior first.
TTM_OLD = TtmRule(partial=(170, 290), start=5, prior=(355, 380), duration=5, prior_newest=True)


def trailing_twelve_months(facts: DataFrame, rule: TtmRule = TTM, carry: tuple[str, ...] = (), sources: bool = False) -> DataFrame:
    """entity, concept, value, end, strategy. A: the newest four quarters if they follow each other;
    B: the newest year plus the part after it less the same part a year earlier; C: the newest year.
    carry: columns that are the same in all rows of a series; sources: adds rows, the seq of the rows that made the value."""
    # every window and the aggregation partition by the keys: one shuffle at most
    series = W.partitionBy(*KEYS)
    dp = facts.select(*KEYS, "seq", "start", "end", "val", *carry).withColumns({"_d": inclusive_days("start", "end")})
    dp = dp.withColumn("_year", F.max(F.when(F.col("_d").between(*rule.annual), F.struct("end", (-F.col("seq")).alias("s"), "val"))).over(series))
    part = F.col("start").isNotNull() & F.col("_d").between(*rule.partial) & (F.abs(F.datediff("start", "_year.end")) <= rule.start)
    dp = dp.withColumn("_part", F.max(F.when(part, F.struct("end", (-F.col("seq")).alias("s"), F.col("_d").alias("d"), "val"))).over(series))
    quarters = W.partitionBy(*KEYS, "_quarter")
    dp = dp.withColumn("_quarter", F.coalesce(F.col("_d").between(*rule.quarter), F.lit(False)))
    dp = dp.withColumn("_rn", F.row_number().over(quarters.orderBy(F.desc("end"), "seq")))
    dp = dp.withColumn("_off", F.abs(F.datediff("start", F.lag("end").over(quarters.orderBy("end", F.desc("_rn"))))))
    newest = F.col("_quarter") & (F.col("_rn") <= 4)
    prior = (F.col("seq") != -F.col("_part.s")) & F.col("start").isNotNull() & F.datediff("_part.end", "end").between(*rule.prior) & (F.abs(F.col("_d") - F.col("_part.d")) <= rule.duration)
    if rule.prior_newest:
        priors = F.max(F.when(prior, F.struct("end", (-F.col("seq")).alias("s"), "val")))
    else:
        priors = F.min(F.when(prior, F.struct("seq", "val")))
    made = dp.groupBy(*KEYS).agg(F.count_if(newest).alias("n"), F.max(F.when(newest & (F.col("_rn") < 4), F.col("_off"))).alias("off"), F.sum(F.when(newest, F.col("val"))).alias("sum"), F.max(F.when(newest, F.col("end"))).alias("last"), F.first("_year").alias("y"), F.first("_part").alias("p"), priors.alias("r"), *[F.first(c).alias(c) for c in carry], *([F.array_sort(F.collect_list(F.when(newest, F.col("seq")))).alias("q")] if sources else []))
    four = (F.col("n") == 4) & (F.coalesce("off", F.lit(0)) <= rule.gap)
    a_value, a_end = F.when(four, F.col("sum")), F.when(four, F.col("last"))
    b_value = F.col("y.val") + F.col("p.val") - F.col("r.val")
    strategy = F.when(a_end.isNotNull(), "A").when(b_value.isNotNull(), "B").when(F.col("y.end").isNotNull(), "C")
    found = [*KEYS, F.coalesce(a_value, b_value, "y.val").alias("value"), F.when(strategy == "A", a_end).when(strategy == "B", F.col("p.end")).otherwise(F.col("y.end")).alias("end"), strategy.alias("strategy"), *carry]
    if sources:
        prior_seq = -F.col("r.s") if rule.prior_newest else F.col("r.seq")
        rows = F.when(strategy == "A", F.col("q")).when(strategy == "B", F.array_sort(F.array(-F.col("y.s"), -F.col("p.s"), prior_seq))).when(strategy == "C", F.array(-F.col("y.s")))
        found.append(rows.alias("rows"))
    return made.select(*found)


def last_value(facts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, val, end of the latest period; the first on ties."""
    top = F.max_by(F.struct("val", "end"), F.struct(F.col("end"), -F.col("seq")))
    return facts.filter("val is not null and end is not null").groupBy(*keys).agg(top.alias("t")).select(*keys, "t.val", "t.end")


def annual_series(facts: DataFrame, by: str = "end", instants: bool = True) -> DataFrame:
    """Annual rows, one for each `by` (end, or fy: the old rule that merges comparatives). Years are
    durations, and with `instants` balance-sheet rows of annual forms."""
    d = inclusive_days("start", "end")
    keep = d.between(*TTM.annual)
    if instants:
        keep = F.coalesce(keep, F.lit(False)) | (F.col("start").isNull() & F.col("form").isin(*ANNUAL_FORMS))
    return _first(facts.filter(keep), [*KEYS, by], F.desc_nulls_last("filed"), F.asc("seq"))


def cagr(series: DataFrame, years: int = 5, robust: bool = False) -> DataFrame:
    """Growth from the value `years` places before the last to the last; NULL if one isn't positive,
    or, if robust, if the base is under a tenth of the upper median."""
    ranked = series.withColumn("_rn", F.row_number().over(W.partitionBy(*KEYS).orderBy(F.desc("end"))))
    values = F.array_sort(F.collect_list("val"))
    made = ranked.groupBy(*KEYS).agg(F.max(F.when(F.col("_rn") == 1, F.col("val"))).alias("last"), F.max(F.when(F.col("_rn") == years + 1, F.col("val"))).alias("base"), upper_median(values).alias("median"))
    good = (F.col("last") > 0) & (F.col("base") > 0)
    if robust:
        good &= F.col("base") >= 0.1 * F.col("median")
    growth = F.when(good, F.pow(F.col("last").cast("double") / F.col("base").cast("double"), F.lit(1.0 / years)) - 1)
    return made.select(*KEYS, growth.alias("cagr"))


def clean_annual(facts: DataFrame) -> DataFrame:
    """Annual durations with a value, one for each end."""
    return annual_series(facts.filter("val is not null"), instants=False)


def upper_median(sorted_values) -> Column:
    return F.try_element_at(sorted_values, F.floor(F.size(sorted_values) / 2).cast("int") + 1)


def year_earlier(facts: DataFrame, low: int = 300, high: int = 430) -> DataFrame:
    """keys, val, end of the last balance and prior, the latest that is low to high days older."""
    known = F.col("val").isNotNull() & F.col("end").isNotNull()
    last = F.max(F.when(known, F.struct("end", (-F.col("seq")).alias("s"), "val"))).over(W.partitionBy(*KEYS))
    older = F.when(F.datediff("_last.end", "end").between(low, high), F.struct("end", (-F.col("seq")).alias("s"), "val"))
    made = facts.select(*KEYS, "end", "val", "seq").withColumn("_last", last).filter("_last is not null").groupBy(*KEYS).agg(F.first("_last").alias("l"), F.max(older).alias("o"))
    return made.select(*KEYS, "l.val", "l.end", F.col("o.val").alias("prior"))


def average_balance(facts: DataFrame) -> DataFrame:
    """Mean of the last balance and the one about a year older; the last alone without one."""
    return year_earlier(facts).withColumn("average", F.coalesce((F.col("val") + F.col("prior")) / 2, F.col("val")))


def stale(end, as_of: str, years: float = 2.0) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), end) / 365.25 > years


def within_history(facts: DataFrame, as_of: str, days: int = 6 * 365) -> DataFrame:
    """Rows that end within the history, or whose end is unknown."""
    return facts.filter((F.col("end") >= F.date_sub(F.lit(as_of).cast("date"), days)) | F.col("end").isNull())


def as_known_at(rows: DataFrame, keys: list[str], when: str, vintage: str = "restated") -> DataFrame:
    """The latest vintage of each key that was known at a date."""
    return _first(rows.filter(F.col(vintage) <= F.lit(when).cast("date")), keys, F.desc(vintage))

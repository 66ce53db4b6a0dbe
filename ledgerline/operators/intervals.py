"""Joins of rows that lie near each other: by bands of differences, and by what was valid at a time.

A band join deals the right rows to bins as wide as the band. A left row probes the two bins
of each band in which its partners can lie, so the join is an equality on keys and bins. What is compared
grows with the matches, not with the square of a key's rows, and a key with very many rows is spread
over its bins. A partner lies in one bin only, so no pair is found twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import inclusive_days
from ledgerline.operators.periods import KEYS, TTM, TtmRule

#: Most dates that are shipped to every task.
MOST_DATES = 10_000


@dataclass(frozen=True)
class Band:
    """low <= left - right <= high, for whole numbers (days since 1970 for dates)."""

    left: Column
    right: Column
    low: int
    high: int

    @property
    def width(self) -> int:
        return self.high - self.low + 1


def day(c: str) -> Column:
    return F.unix_date(F.col(c).cast("date"))


def band_candidates(left: DataFrame, right: DataFrame, keys: list[str], bands: list[Band]) -> DataFrame:
    """Pairs by keys and bins, with the differences as _d0, _d1, ...: all matches and near misses.
    The sides' other columns need different names."""
    for k, b in enumerate(bands):
        right = right.withColumn(f"_r{k}", b.right).withColumn(f"_bin{k}", F.floor(F.col(f"_r{k}") / b.width))
        left = left.withColumn(f"_l{k}", b.left)
        probes = F.array_distinct(F.array(F.floor((F.col(f"_l{k}") - b.high) / b.width), F.floor((F.col(f"_l{k}") - b.low) / b.width)))
        left = left.filter(F.col(f"_l{k}").isNotNull()).withColumn(f"_bin{k}", F.explode(probes))
    pairs = left.join(right, [*keys, *[f"_bin{k}" for k in range(len(bands))]])
    return pairs.withColumns({f"_d{k}": F.col(f"_l{k}") - F.col(f"_r{k}") for k in range(len(bands))}).drop(*[f"{x}{k}" for k in range(len(bands)) for x in ("_l", "_r", "_bin")])


def band_join(left: DataFrame, right: DataFrame, keys: list[str], bands: list[Band]) -> DataFrame:
    """Pairs of rows with equal keys whose differences lie in all bands. NULLs match nothing."""
    found = band_candidates(left, right, keys, bands)
    for k, b in enumerate(bands):
        found = found.filter(F.col(f"_d{k}").between(b.low, b.high))
    return found.drop(*[f"_d{k}" for k in range(len(bands))])


def year_earlier_bands(rule: TtmRule = TTM) -> list[Band]:
    return [Band(day("end"), day("prior_end"), *rule.prior), Band(F.col("d"), F.col("prior_d"), -rule.duration, rule.duration)]


def year_earlier_sides(facts: DataFrame, keys: list[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    d = facts.select(*keys, "seq", "end", inclusive_days("start", "end").alias("d")).filter("d is not null")
    return d, d.withColumnsRenamed({"seq": "prior_seq", "end": "prior_end", "d": "prior_d"})


def year_earlier_pairs(facts: DataFrame, rule: TtmRule = TTM, keys: list[str] = KEYS) -> DataFrame:
    """Pairs of periods of one series, about a year apart and about equally long."""
    return band_join(*year_earlier_sides(facts, keys), keys, year_earlier_bands(rule)).filter("seq <> prior_seq")


def earlier_balances(facts: DataFrame, low: int = 300, high: int = 430, keys: list[str] = KEYS) -> DataFrame:
    """Every balance (keys, seq, end, val) with prior and prior_end: the latest one that is low to high
    days older, the first by seq on ties; NULL if there is none."""
    known = facts.filter("val is not null and end is not null").select(*keys, "seq", "end", "val")
    older = known.select(*keys, F.col("seq").alias("_s"), F.col("end").alias("_e"), F.col("val").alias("_v"))
    near = band_join(known, older, keys, [Band(day("end"), day("_e"), low, high)])
    best = near.groupBy(*keys, "seq").agg(F.max_by(F.struct("_v", "_e"), F.struct("_e", -F.col("_s"))).alias("_o"))
    return known.join(best, [*keys, "seq"], "left").select(*keys, "seq", "end", "val", F.col("_o._v").alias("prior"), F.col("_o._e").alias("prior_end"))


def following_parts(facts: DataFrame, rule: TtmRule = TTM, keys: list[str] = KEYS) -> DataFrame:
    """Every year (keys, year_seq, year_end) with the newest part (part_seq, part_end) that starts within days of its end."""
    d = inclusive_days("start", "end")
    years = facts.filter(d.between(*rule.annual)).select(*keys, F.col("seq").alias("year_seq"), F.col("end").alias("year_end"))
    parts = facts.filter(d.between(*rule.partial) & F.col("start").isNotNull()).select(*keys, F.col("seq").alias("part_seq"), F.col("start").alias("part_start"), F.col("end").alias("part_end"))
    near = band_join(parts, years, keys, [Band(day("part_start"), day("year_end"), -rule.start, rule.start)])
    best = near.groupBy(*keys, "year_seq").agg(F.max_by(F.struct("part_seq", "part_end"), F.struct("part_end", -F.col("part_seq"))).alias("_p"))
    return years.join(best, [*keys, "year_seq"], "left").select(*keys, "year_seq", "year_end", "_p.part_seq", "_p.part_end")


# vintages


def validity(rows: DataFrame, keys: list[str], vintage: str = "restated", seq: str = "seq") -> DataFrame:
    """rows with valid_from and valid_to: a vintage holds until the next of its key, the last for ever (NULL).
    Of vintages of one date the last by seq holds; rows without a vintage were never known."""
    known = rows.filter(F.col(vintage).isNotNull())
    order = W.partitionBy(*keys).orderBy(vintage, seq)
    held = known.withColumns({"valid_from": F.col(vintage), "valid_to": F.lead(vintage).over(order)})
    return held.filter("valid_to is null or valid_to > valid_from")


def known_at_dates(rows: DataFrame, keys: list[str], dates: list[date], vintage: str = "restated", seq: str = "seq") -> DataFrame:
    """For each of the dates the vintage of each key that was known then, with the date as as_of.
    One shuffle by keys; each vintage makes one row for each date at which it held."""
    if len(dates) > MOST_DATES:
        raise ValueError(f"{len(dates)} dates: at most {MOST_DATES} go to every task; use as_of_join")
    all_dates = F.array(*[F.lit(x) for x in sorted(set(dates))]).cast("array<date>")
    inside = F.filter(all_dates, lambda x: (x >= F.col("valid_from")) & F.coalesce(x < F.col("valid_to"), F.lit(True)))
    return validity(rows, keys, vintage, seq).withColumn("as_of", F.explode(inside)).drop("valid_from", "valid_to")


def as_of_join(wanted: DataFrame, rows: DataFrame, keys: list[str], when: str, vintage: str = "restated", seq: str = "seq") -> DataFrame:
    """wanted with the columns of the vintage of its key that was known at `when` (NULLs if none was). Both sides are
    merged in order of time in one shuffle by keys, and each wanted row takes the last vintage before it."""
    others = [c for c in rows.columns if c not in keys]
    asked = wanted.select(*keys, F.col(when).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_seq"), F.struct(*wanted.columns).alias("_w"), F.lit(None).cast(rows.select(F.struct(*others)).schema[0].dataType).alias("_r"))
    there = rows.filter(F.col(vintage).isNotNull()).select(*keys, F.col(vintage).alias("_t"), F.lit(0).alias("_side"), F.col(seq).cast("long").alias("_seq"), F.lit(None).cast(wanted.select(F.struct(*wanted.columns)).schema[0].dataType).alias("_w"), F.struct(*others).alias("_r"))
    merged = W.partitionBy(*keys).orderBy("_t", "_side", "_seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = asked.unionByName(there).withColumn("_r", F.when(F.col("_t").isNotNull(), F.last("_r", ignorenulls=True).over(merged))).filter("_side = 1")
    return found.select("_w.*", *[F.col("_r")[c].alias(c) for c in others if c not in wanted.columns])


# trailing twelve months at every period end


def rolling_twelve_months(facts: DataFrame, rule: TtmRule = TTM) -> DataFrame:
    """entity, concept, as_of, value, end, strategy: the trailing twelve months as each period end of a series saw
    them, from the periods that had ended by then (see periods.trailing_twelve_months). One shuffle by the keys: a
    scan of the sorted series that keeps the newest four quarters, the newest year, its parts and the same
    parts a year earlier. Rows without an end are left out, and parts that
    end before they start."""
    series = W.partitionBy(*KEYS)
    dp = facts.select(*KEYS, "seq", "start", "end", "val").withColumns({"_d": inclusive_days("start", "end"), "_t": day("end")}).filter("end is not null")
    newest = lambda *c: F.struct("end", (-F.col("seq")).alias("s"), *c)
    until = series.orderBy("_t").rangeBetween(W.unboundedPreceding, W.currentRow)
    # the four quarters that end with each quarter, in order of end, the first by seq last
    dp = dp.withColumn("_quarter", F.coalesce(F.col("_d").between(*rule.quarter), F.lit(False)))
    quarters = W.partitionBy(*KEYS, "_quarter").orderBy("_t", F.desc("seq"))
    dp = dp.withColumn("_off", F.abs(F.datediff("start", F.lag("end").over(quarters))))
    four, three = quarters.rowsBetween(-3, W.currentRow), quarters.rowsBetween(-2, W.currentRow)
    dp = dp.withColumns({"_n": F.count(F.lit(1)).over(four), "_sum": F.sum("val").over(four), "_gap": F.max("_off").over(three)})
    dp = dp.withColumns({"_q": F.max(F.when(F.col("_quarter"), newest("_n", "_sum", "_gap"))).over(until), "_y": F.max(F.when(F.col("_d").between(*rule.annual), newest("val"))).over(until)})
    # ends of the years that a part may follow: those of the days around its start; and what ended a year before it
    longest = rule.partial[1] + rule.start
    before = series.orderBy("_t").rangeBetween(-longest, rule.start)
    ends = F.collect_set(F.when(F.col("_d").between(*rule.annual), F.col("end"))).over(before)
    earlier = series.orderBy("_t").rangeBetween(-rule.prior[1], -rule.prior[0])
    priors = F.collect_list(F.when(F.col("start").isNotNull(), F.struct("seq", "end", F.col("_d").alias("d"), "val"))).over(earlier)
    dp = dp.withColumns({"_ends": ends, "_priors": priors})
    is_part = F.col("start").isNotNull() & F.col("_d").between(max(1, rule.partial[0]), rule.partial[1])
    follows = F.when(is_part, F.filter("_ends", lambda y: F.abs(F.datediff("start", y)) <= rule.start)).otherwise(F.array().cast("array<date>"))
    same = F.filter("_priors", lambda o: (o["seq"] != F.col("seq")) & (F.abs(o["d"] - F.col("_d")) <= rule.duration))
    if rule.prior_newest:
        prior = F.array_max(F.transform(same, lambda o: F.struct(o["end"].alias("e"), (-o["seq"]).alias("s"), o["val"].alias("val"))))["val"]
    else:
        prior = F.array_min(F.transform(same, lambda o: F.struct(o["seq"].alias("s"), o["val"].alias("val"))))["val"]
    # each row asks for the newest part behind its year, and is a part behind the years that it follows
    first = F.row_number().over(W.partitionBy(*KEYS, "end").orderBy("seq")) == 1
    dp = dp.withColumns({"_prior": prior, "_asks": first})
    roles = F.concat(F.array(F.struct(F.col("_y.end").alias("year"), F.col("_asks").alias("asks"), F.lit(False).alias("part"))), F.transform(follows, lambda y: F.struct(y.alias("year"), F.lit(False).alias("asks"), F.lit(True).alias("part"))))
    dp = dp.withColumn("_role", F.explode(roles)).withColumn("_year", F.col("_role.year"))
    behind = W.partitionBy(*KEYS, "_year").orderBy("_t").rangeBetween(W.unboundedPreceding, W.currentRow)
    part = F.max(F.when(F.col("_role.part"), newest("val", F.col("_prior").alias("prior")))).over(behind)
    made = dp.withColumn("_p", part).filter("_role.asks")
    whole = (F.col("_q._n") == 4) & (F.coalesce("_q._gap", F.lit(0)) <= rule.gap)
    a_value, a_end = F.when(whole, F.col("_q._sum")), F.when(whole, F.col("_q.end"))
    b_value = F.col("_y.val") + F.col("_p.val") - F.col("_p.prior")
    strategy = F.when(a_end.isNotNull(), "A").when(b_value.isNotNull(), "B").when(F.col("_y.end").isNotNull(), "C")
    end = F.when(strategy == "A", a_end).when(strategy == "B", F.col("_p.end")).otherwise(F.col("_y.end"))
    return made.select(*KEYS, F.col("end").alias("as_of"), F.coalesce(a_value, b_value, "_y.val").alias("value"), end.alias("end"), strategy.alias("strategy"))

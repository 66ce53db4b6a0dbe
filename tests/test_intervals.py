"""Band joins, vintages and rolling trailing months against plain re-statements."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import intervals, periods

D = dt.date.fromisoformat
DAY = dt.timedelta(days=1)
SCHEMA = "entity string, concept string, seq int, start date, end date, val double"


def _series(spark, seed, n):
    rnd = random.Random(seed)
    rows = []
    for e in ("a", "b", None):
        for seq in range(n):
            end = D("2015-01-01") + DAY * rnd.randrange(2500)
            start = None if rnd.random() < 0.1 else end - DAY * (rnd.choice([90, 91, 181, 270, 364, 365, 364]) - 1 + rnd.randrange(-3, 4))
            rows.append((e, "c", seq, start, None if rnd.random() < 0.03 else end, None if rnd.random() < 0.05 else float(rnd.randrange(100))))
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_year_earlier_pairs(spark):
    rows, df = _series(spark, 1, 120)
    days = lambda r: (r[4] - r[3]).days + 1
    full = [r for r in rows if r[0] and r[3] and r[4]]
    wanted = sorted((a[0], a[2], b[2]) for a in full for b in full if a[0] == b[0] and a[2] != b[2] and 350 <= (a[4] - b[4]).days <= 380 and abs(days(a) - days(b)) <= 7)
    assert sorted(map(tuple, intervals.year_earlier_pairs(df).select("entity", "seq", "prior_seq").collect())) == wanted
    assert len(wanted) > 50


def test_pairs_compared_grow_with_the_matches(spark):
    """One series of 100,000 periods, three days apart: 5e9 pairs by a self-join, a few for each match by bins."""
    n = 100_000
    at = F.date_add(F.lit("1000-01-01").cast("date"), (F.col("id") * 3).cast("int"))
    df = spark.range(n).select(F.lit("e").alias("entity"), F.lit("c").alias("concept"), F.col("id").cast("int").alias("seq"), F.date_sub(at, 89).alias("start"), at.alias("end"), F.lit(1.0).alias("val"))
    sides = intervals.year_earlier_sides(df)
    compared = intervals.band_candidates(*sides, periods.KEYS, intervals.year_earlier_bands()).count()
    matches = intervals.year_earlier_pairs(df).count()
    assert n * 9 < matches < n * 12
    assert compared < 4 * matches


def test_earlier_balances_and_following_parts(spark):
    rows, df = _series(spark, 2, 100)
    days = lambda r: (r[4] - r[3]).days + 1
    known = [r for r in rows if r[4] and r[5] is not None]
    wanted = set()
    for r in known:
        older = [o for o in known if o[0] == r[0] is not None and 300 <= (r[4] - o[4]).days <= 430]
        o = max(older, key=lambda o: (o[4], -o[2]), default=None)
        wanted.add((r[0], r[2], o and o[5], o and o[4]))
    assert {tuple(r) for r in intervals.earlier_balances(df).select("entity", "seq", "prior", "prior_end").collect()} == wanted
    full = [r for r in rows if r[3] and r[4]]
    wanted = set()
    for y in (r for r in full if 355 <= days(r) <= 380):
        p = max((o for o in full if o[0] == y[0] is not None and days(o) <= 300 and abs((o[3] - y[4]).days) <= 7), key=lambda o: (o[4], -o[2]), default=None)
        wanted.add((y[0], y[2], p and p[2], p and p[4]))
    assert {tuple(r) for r in intervals.following_parts(df).select("entity", "year_seq", "part_seq", "part_end").collect()} == wanted


VINTAGES = [("x", 0, D("2020-01-01"), 1), ("x", 1, D("2020-03-01"), 2), ("x", 2, D("2020-03-01"), 3), ("y", 0, D("2020-02-01"), 4), ("y", 1, None, 5), ("z", 0, D("2021-01-01"), 6)]


def test_known_at_dates_equals_known_at_each(spark):
    rows = spark.createDataFrame(VINTAGES, "key string, seq int, restated date, val int")
    dates = [D("2019-12-31"), D("2020-01-01"), D("2020-02-01"), D("2020-03-01"), D("2022-01-01"), D("2022-01-01")]
    found = intervals.known_at_dates(rows, ["key"], dates)
    assert found.count() == 8
    for at in set(dates):
        one = {(r["key"], r["restated"]) for r in periods.as_known_at(rows, ["key"], str(at)).collect()}
        assert {(r["key"], r["restated"]) for r in found.filter(F.col("as_of") == F.lit(at)).collect()} == one
    assert found.filter("as_of = '2020-03-01' and key = 'x'").first()["val"] == 3  # the last by seq
    with pytest.raises(ValueError):
        intervals.known_at_dates(rows, ["key"], [D("2000-01-01") + DAY * k for k in range(10_001)])


def test_dates_take_one_shuffle(spark):
    rows = spark.createDataFrame(VINTAGES, "key string, seq int, restated date, val int")
    wanted = spark.createDataFrame([("x", D("2020-03-02"))], "key string, asked date")
    for df in (intervals.known_at_dates(rows, ["key"], [D("2020-01-01")]), intervals.as_of_join(wanted, rows, ["key"], "asked")):
        df.collect()
        assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_as_of_join(spark):
    rows = spark.createDataFrame(VINTAGES, "key string, seq int, restated date, val int")
    asks = [("x", D("2019-01-01"), 1), ("x", D("2020-01-01"), 2), ("x", D("2020-03-01"), 3), ("x", D("2020-03-01"), 3), ("y", D("2030-01-01"), 4), ("q", D("2030-01-01"), 5), ("x", None, 6)]
    found = intervals.as_of_join(spark.createDataFrame(asks, "key string, asked date, n int"), rows, ["key"], "asked")
    assert found.columns == ["key", "asked", "n", "seq", "restated", "val"]
    assert sorted((r["n"], r["val"]) for r in found.collect() if r["val"]) == [(2, 1), (3, 3), (3, 3), (4, 4)]
    assert found.count() == len(asks)


@pytest.mark.parametrize("rule", [periods.TTM, periods.TTM_OLD])
def test_rolling_equals_the_trailing_months_of_what_had_ended(spark, rule):
    """At every period end: the same as the newest trailing months of the periods up to it."""
    rows, _ = _series(spark, 5, 60)
    rows = [r for r in rows if r[0] and r[4]]
    rnd, seq = random.Random(9), 0
    for e, gone in (("r", 0.0), ("s", 0.3)):  # calendar quarters, halves, nine months and years, of some of which are missing
        for y in range(2015, 2021):
            for first, last in ((1, 3), (4, 6), (7, 9), (10, 12), (1, 6), (1, 9), (1, 12)):
                if rnd.random() >= gone and not (e == "s" and (first, last) == (10, 12)):
                    rows.append((e, "c", seq := seq + 1, dt.date(y, first, 1 + rnd.randrange(3)), dt.date(y, last, 28), float(rnd.randrange(100))))
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r["entity"], r["as_of"]): (r["value"], r["end"], r["strategy"]) for r in intervals.rolling_twelve_months(df, rule).collect()}
    ends = sorted({(r[0], r[4]) for r in rows})
    assert sorted(found) == ends
    copies = [(f"{e} {at}", *r[1:]) for e, at in ends for r in rows if r[0] == e and r[4] <= at]
    each = {r["entity"]: (r["value"], r["end"], r["strategy"]) for r in periods.trailing_twelve_months(spark.createDataFrame(copies, SCHEMA), rule).collect()}
    assert {f"{e} {at}": v for (e, at), v in found.items()} == each
    last = {r["entity"]: (r["value"], r["end"], r["strategy"]) for r in periods.trailing_twelve_months(df, rule).collect()}
    assert {e: found[e, max(at for x, at in ends if x == e)] for e in "abrs"} == last
    assert {v[2] for v in found.values()} == {"A", "B", "C", None}

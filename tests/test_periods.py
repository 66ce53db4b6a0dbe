"""Hand-sized vectors of the period algebra and column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import periods

D = dt.date.fromisoformat


def facts(spark, rows):
    rows = [("e", "c", i, D(s) if s else None, D(e), float(v)) for i, (s, e, v) in enumerate(rows)]
    return spark.createDataFrame(rows, "entity string, concept string, seq int, start date, end date, val double")


QUARTERS = [("2024-01-01", "2024-03-31", 1), ("2024-04-01", "2024-06-30", 2), ("2024-07-01", "2024-09-30", 3), ("2024-10-01", "2024-12-31", 4)]
CASES = {
    "four quarters": (QUARTERS, 10, "A"),
    "a gap": ([*QUARTERS[:2], ("2024-07-08", "2024-10-07", 3), ("2024-10-15", "2025-01-14", 4), ("2023-01-01", "2023-12-31", 9)], 9, "C"),
    "year, part, part a year before": ([("2024-01-01", "2024-12-31", 18.25), ("2025-01-01", "2025-03-31", -4.24), ("2024-01-01", "2024-03-31", 5.08)], 8.93, "B"),
    "halves only": ([("2024-01-01", "2024-06-30", 5)], None, None),
}


@pytest.mark.parametrize("name", CASES)
def test_trailing_twelve_months(spark, name):
    rows, value, strategy = CASES[name]
    found = periods.trailing_twelve_months(facts(spark, rows)).first()
    assert found["strategy"] == strategy
    assert found["value"] == (pytest.approx(value) if value is not None else None)


def test_latest_filed_takes_the_first_of_equal_ones(spark):
    rows = [("e", "c", 0, None, D("2024-12-31"), 1.0, D("2025-02-01")), ("e", "c", 1, None, D("2024-12-31"), 2.0, D("2026-02-01")), ("e", "c", 2, None, D("2024-12-31"), 3.0, D("2026-02-01"))]
    df = spark.createDataFrame(rows, "entity string, concept string, seq int, start date, end date, val double, filed date")
    assert [r["val"] for r in periods.latest_filed(df).collect()] == [2.0]


def test_growth_with_a_tiny_base(spark):
    rows = [(f"{y}-01-01", f"{y}-12-31", v) for y, v in zip(range(2019, 2025), (0.02, 2, 2, 2, 2, 2.55), strict=True)]
    series = facts(spark, rows)
    assert periods.cagr(series).first()["cagr"] == pytest.approx(127.5**0.2 - 1)
    assert periods.cagr(series, robust=True).first()["cagr"] is None


def test_average_of_balances(spark):
    rows = [(None, "2025-12-31", 10), (None, "2024-12-31", 6), (None, "2025-09-30", 9)]
    assert periods.average_balance(facts(spark, rows)).first()["average"] == 8


EXPRESSIONS = [
    (lambda: C.argentine_number(F.lit("(1.498.010.431.426)")), -1498010431426.0),
    (lambda: C.percent_number(F.lit("29,36%")), 29.36),
    (lambda: C.percent_number(F.lit("1.234,5")), None),
    (lambda: C.english_number(F.lit("(1,234.5)")), -1234.5),
    (lambda: C.ticker_variants(F.lit("BRK.B")), ["BRK.B", "BRK-B", "BRK"]),
    (lambda: C.month_end(F.lit(2024), F.lit(2)), D("2024-02-29")),
    (lambda: C.month_end(F.lit(2024), F.lit(None).cast("int")), D("2024-12-31")),
    (lambda: C.total_debt(F.lit(None).cast("int"), F.lit(5), F.lit(0), F.lit(7)), 12),
    (lambda: C.period_class(F.lit(121)), "half"),
    (lambda: C.period_class(F.lit(None).cast("int")), "unknown"),
    (lambda: C.identity_gap(F.lit(2_100_000.0), F.lit(800_000.0), F.lit(1_300_000.0)), 0.0),
    (lambda: C.sorted_tokens(F.lit("Banco  Macro SA")), "banco macro sa"),
    (lambda: C.joined_numbers(F.lit("1 234 .5 x")), "1234.5 x"),
    (lambda: C.label_number(F.lit("Resultado neto: (1.500) x"), ["resultado neto"]), -1500.0),
    (lambda: C.divergence_text(F.lit(2.449)), "+2,45%"),
    (lambda: C.padded_cik(F.lit(12)), "0000000012"),
    (lambda: C.page_fault(F.lit("")), "empty_response"),
    (lambda: C.page_fault(F.lit("x" * 12_000 + " CAPTCHA")), "captcha"),
    (lambda: C.safe_ratio(F.lit(1.0), F.lit(0.0)), None),
]


@pytest.mark.parametrize("k", range(len(EXPRESSIONS)))
def test_expression(spark, k):
    make, wanted = EXPRESSIONS[k]
    assert spark.range(1).select(make().alias("x")).first()["x"] == wanted


def test_exact_percentiles(spark):
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from ledgerline.operators import stats

    rnd = random.Random(4)
    groups = {"a": [rnd.gauss(0, 100) for _ in range(900)], "b": [5.0] * 40, "c": [-1.5], "d": [rnd.expovariate(1) * 10 ** rnd.randrange(-3, 9) for _ in range(300)] + [0.0] * 20, "e": [float(rnd.randrange(4)) for _ in range(100)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("f", None)]
    points = (0.0, 0.1, 0.5, 0.95, 0.99, 1.0)
    found = {r.g: r["_p"] for r in stats.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), "g", F.col("v"), points).collect()}
    assert found.keys() == groups.keys()
    for g, vs in groups.items():
        assert np.allclose(found[g], np.quantile(vs, points), rtol=1e-12, atol=1e-12)

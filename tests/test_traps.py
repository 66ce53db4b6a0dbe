"""Traps of the sources, each with the rule that keeps us out of it; and retries, tags, documents in parts, template ratios."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import joins, periods, ratios, stats, template
from ledgerline.sources import readers, sinks
from ledgerline.streaming import incremental

D = dt.date.fromisoformat


def test_two_durations_with_one_end_don_t_collide(spark):
    """A quarter and nine months of one end and filing: a key without start and unit drops one, ours keeps both."""
    rows = [("e", "c", "USD", D("2024-07-01"), D("2024-09-30"), D("2024-11-01"), 1.0), ("e", "c", "USD", D("2024-01-01"), D("2024-09-30"), D("2024-11-01"), 3.0), ("e", "c", "EUR", D("2024-01-01"), D("2024-09-30"), D("2024-11-01"), 4.0)]
    df = spark.createDataFrame(rows, "entity string, concept string, unit string, start date, end date, filed date, val double")
    full = ["entity", "concept", "unit", "start", "end", "filed"]
    assert sinks.insert_new(df.limit(0), df, full, ["val"]).count() == 3
    assert sinks.insert_new(df.limit(0), df, ["entity", "concept", "end", "filed"], ["val"]).first()["val"] == 1.0  # the contract's key, on request


def test_duplicates_of_a_period_go_before_the_trailing_months(spark):
    q = [("01-01", "03-31"), ("04-01", "06-30"), ("07-01", "09-30"), ("10-01", "12-31")]
    rows = [("e", "c", 2 * k + late, D(f"2024-{a}"), D(f"2024-{b}"), float(k), D("2025-02-01") + dt.timedelta(days=90 * late)) for k, (a, b) in enumerate(q) for late in (0, 1)]
    df = spark.createDataFrame(rows, "entity string, concept string, seq int, start date, end date, val double, filed date")
    assert periods.trailing_twelve_months(df).first()["strategy"] is None  # quarters twice
    assert periods.trailing_twelve_months(periods.latest_filed(df)).first()["strategy"] == "A"


def test_zero_is_missing_where_the_rule_says_so_only(spark):
    one = spark.range(1).select(F.lit(0.0).alias("net_income"), F.lit(10.0).alias("shares"), F.lit(5.0).alias("revenue"))
    found = ratios.with_ratios(one).first()
    assert found["eps"] is None and found["net_margin"] == 0.0


def test_not_a_number_is_missing(spark, tmp_path):
    path = str(tmp_path / "c")
    with open(path, "w") as f:
        f.write("k,v\n1,NaN\n2,\n3,4.5\n")
    df = readers.read_csv(spark, path, "k int, v double")
    assert [r["v"] for r in df.orderBy("k").collect()] == [None, None, 4.5]
    assert df.filter("v > 1").count() == 1
    nan = spark.range(1).select(F.lit("NaN").cast("double").alias("v"), F.lit("g").alias("g"))
    assert stats.exact_percentiles(nan, "g", F.col("v"), (0.5,)).count() == 0


def test_a_join_that_may_not_multiply_rows_says_so(spark):
    left = spark.createDataFrame([("T", k) for k in range(4)] + [("U", 9)], "ticker string, k int")
    assert left.join(left.withColumnRenamed("k", "j"), "ticker").count() == 17
    with pytest.raises(Exception, match="several rows of one ticker: T"):
        left.join(joins.unique_by(left.withColumnRenamed("k", "j"), ["ticker"]), "ticker").collect()
    assert joins.unique_by(left.filter("ticker = 'U'"), ["ticker"]).count() == 1


def test_keys_as_text(spark):
    floats = spark.createDataFrame([(12.0,), (float("nan"),), (None,), (12.5,)], "k double").select(C.key_text("k").alias("k"))
    ints = spark.createDataFrame([(12,), (None,)], "k long").select(C.key_text("k").alias("k"))
    texts = spark.createDataFrame([("12",), ("12.0",), ("nan",), ("",), ("x",)], "k string").select(C.key_text("k").alias("k"))
    assert [r["k"] for r in floats.collect()] == ["12", None, None, None]
    assert [r["k"] for r in texts.collect()] == ["12", "12", None, None, None]
    assert floats.join(ints, "k").count() == 1


def test_bare_numbers_make_a_page_invalid_as_in_the_source(spark):
    """The cascade finds 404 and 503 anywhere, so an amount of 1,404 makes a page invalid; that is the rule, kept on purpose."""
    page = "x" * 12_000
    found = spark.createDataFrame([(page,), (page + " total 1404 pesos",), (page + " 1503 ",)], "p string").select(C.page_fault("p").alias("f"))
    faults = [r["f"] for r in found.collect()]
    assert faults[0] == "ok" and "ok" not in faults[1:]


def test_letters_and_spaces_of_any_script(spark):
    text = "PATRIMONIO NETO ÍNDICE: 5,5"
    one = spark.createDataFrame([(text,)], "t string")
    assert one.select(C.plain_text("t").alias("x")).first()["x"] == "PATRIMONIO NETO ÍNDICE: 5,5"
    assert one.select(C.label_number("t", ["índice"]).alias("x")).first()["x"] == 5.5


def test_attempts(spark):
    log = [(1, "a", 1, "e1"), (1, "a", 2, None), (1, "b", 1, "e1"), (1, "b", 2, "e2"), (1, "b", 3, "e3"), (2, "c", 1, "e1"), (2, "d", 1, "e1"), (2, "d", 2, "e2")]
    df = spark.createDataFrame(log, "job int, item string, attempt int, error string")
    assert sorted(tuple(r) for r in incremental.attempts(df).select("item", "attempts", "state", "wait", "error").collect()) == [("a", 2, "ok", None, None), ("b", 3, "failed", None, "e3"), ("c", 1, "retry", 1, "e1"), ("d", 2, "retry", 3, "e2")]
    assert sorted(tuple(r) for r in incremental.attempted_states(df).select("job", "items", "ok", "failed", "waiting", "state").collect()) == [(1, 2, 1, 1, 0, "done"), (2, 2, 0, 0, 2, "running")]


def test_first_group_of_tags(spark):
    rows = spark.createDataFrame([(1, ["x", "y"]), (2, ["y"]), (3, []), (4, None), (5, ["z", "z"])], "k int, tags array<string>")
    members = spark.createDataFrame([("y", "b"), ("x", "a"), ("y", "c"), ("q", "a"), ("z", "unknown")], "tag string, group string")
    assert {r["k"]: r["group"] for r in joins.first_group(rows, "k", "tags", members, ["a", "b"]).collect()} == {1: "a", 2: "b", 3: "otro", 4: "otro", 5: "otro"}


def test_documents_in_parts(spark):
    rows = spark.range(25).select((F.col("id") % 2).alias("g"), "id", F.lit("v").alias("v"))
    docs = [json.loads(r["document"]) | {"g": r["g"]} for r in sinks.envelope_parts(rows, "now", ["id"], "g", 5).collect()]
    assert sorted((d["g"], d["part"], d["parts"], d["count"]) for d in docs) == [(0, 0, 3, 5), (0, 1, 3, 5), (0, 2, 3, 3), (1, 0, 3, 5), (1, 1, 3, 5), (1, 2, 3, 2)]
    assert sorted(x["id"] for d in docs for x in d["rows"]) == list(range(25))


def test_official_ratios_beside_ours(spark):
    amounts = [("2299999", 50.0), ("3049999", 10.0), ("1999999", 200.0), ("8000009", 0.21), ("8000010", 0.05), ("8000027", 1.5)]
    df = spark.createDataFrame([(1, amounts)], "k int, amounts array<struct<code:string,amount:double>>")
    found = {r["ratio"]: r for r in template.compared(df, "k", "amounts", 2.0).collect()}
    assert len(found) == 12
    assert (found["roe"]["ours"], found["roe"]["agrees"], found["roa"]["agrees"]) == (0.2, False, True)
    assert found["prueba_acida"]["official"] == 1.5 and found["prueba_acida"]["agrees"] is None and found["liquidez"]["official"] is None

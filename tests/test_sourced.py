"""Lineage of figures and mergeable profiles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import lineage, periods, profile

D = dt.date.fromisoformat
FACTS = "entity string, tag string, seq int, start date, end date, val double, filed date"


def _rows():
    q = [("01-01", "03-31"), ("04-01", "06-30"), ("07-01", "09-30"), ("10-01", "12-31")]
    out = [("e", "Sales", k, D(f"2024-{a}"), D(f"2024-{b}"), 10.0 + k, D("2025-02-01")) for k, (a, b) in enumerate(q)]
    out += [("e", "Revenues", 10, D("2020-01-01"), D("2020-12-31"), 99.0, D("2021-02-01"))]  # an older tag of the same concept
    out += [("e", "Profit", 20, D("2023-01-01"), D("2023-12-31"), 8.0, D("2024-02-01")), ("e", "Profit", 21, D("2024-01-01"), D("2024-06-30"), 5.0, D("2024-08-01")), ("e", "Profit", 22, D("2023-01-01"), D("2023-06-30"), 3.0, D("2023-08-01"))]
    out += [("f", "Profit", 30, D("2022-01-01"), D("2022-12-31"), 7.0, D("2023-02-01"))]
    return out


def test_each_ratio_names_its_rows(spark):
    facts = spark.createDataFrame(_rows(), FACTS)
    priorities = spark.createDataFrame([("Revenues", "revenue", 1), ("Sales", "revenue", 2), ("Profit", "income", 1)], "tag string, concept string, priority int")
    metrics = lineage.sourced_metrics(facts, priorities)
    found = {r["entity"]: r for r in lineage.sourced_ratios(metrics, {"margin": lineage.Formula("income", "revenue")}).collect()}
    parts = {p["concept"]: p for p in found["e"]["parts"]}
    assert found["e"]["value"] == pytest.approx(10 / 46)
    assert (parts["revenue"]["tag"], parts["revenue"]["strategy"], parts["revenue"]["rows"], parts["revenue"]["end"]) == ("Sales", "A", [0, 1, 2, 3], D("2024-12-31"))
    assert (parts["income"]["tag"], parts["income"]["strategy"], parts["income"]["rows"], parts["income"]["end"]) == ("Profit", "B", [20, 21, 22], D("2024-06-30"))
    assert found["e"]["stale_end"] == D("2024-06-30")
    assert found["f"]["value"] is None and [(p["concept"], p["strategy"], p["rows"]) for p in found["f"]["parts"]] == [("income", "C", [30])]


@pytest.mark.parametrize("rule", [periods.TTM, periods.TTM_OLD])
def test_the_named_rows_make_the_value(spark, rule):
    rows = [("e", "c", *r[2:6]) for r in _rows() if r[1] == "Profit" and r[0] == "e"]
    found = periods.trailing_twelve_months(spark.createDataFrame(rows, "entity string, concept string, seq int, start date, end date, val double"), rule, sources=True).first()
    assert (found["strategy"], found["rows"], found["value"]) == ("B", [20, 21, 22], 10.0)


def test_merged_profiles_equal_one_pass(spark):
    df = spark.range(20_000).select(
        "id", (F.col("id") % 97).cast("int").alias("a b"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), (F.col("id") % 5000).cast("string"))).alias("text"),
        F.when(F.col("id") % 5 == 0, F.lit("NaN").cast("double")).otherwise(F.col("id") / 7).alias("d"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("day"),
        F.array(F.col("id") % 2).alias("list"), (F.col("id") % 2 == 0).alias("flag"), F.lit(None).cast("decimal(10,2)").alias("none"), F.to_binary(F.lit("6162"), F.lit("hex")).alias("bin"), F.lit("z").alias("n"),
    )
    one = {r["column"]: r for r in profile.finished(profile.profile(df)).collect()}
    parts = [profile.profile(df.filter(F.col("id") % 4 == k)) for k in range(4)] + [profile.profile(df.limit(0))]
    whole = parts[0]
    for p in parts[1:]:
        whole = profile.merged(whole.unionByName(p))
    several = {r["column"]: r for r in profile.finished(whole).collect()}
    assert one.keys() == several.keys() == set(df.columns)
    for c in one:
        assert {k: v for k, v in one[c].asDict().items() if k != "mean"} == {k: v for k, v in several[c].asDict().items() if k != "mean"}
        assert one[c]["mean"] == (pytest.approx(several[c]["mean"]) if several[c]["mean"] is not None else None)
    assert (one["text"]["missing"], one["d"]["missing"], one["none"]["missing"], one["none"]["distinct"]) == (6667, 4000, 20_000, 0)
    assert abs(one["id"]["distinct"] - 20_000) < 1000 and abs(one["text"]["distinct"] - 5000) < 250 and one["a b"]["distinct"] == 97
    assert (one["day"]["least"], one["day"]["most"], one["a b"]["most_number"], one["list"]["least"]) == ("2020-01-01", "2021-02-03", 96.0, "[0]")


def test_one_pass_over_the_table(spark):
    plan = profile.profile(spark.range(10).select("id", F.lit("a").alias("b")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Range") == 1


def test_a_batch_may_run_again(spark, tmp_path):
    for k in (0, 1, 0):
        profile.add_batch(spark.range(10 * k, 10 * k + 10), str(tmp_path / "p"), str(k))
    found = profile.read(spark, str(tmp_path / "p")).first()
    assert (found["n"], found["least_number"], found["most_number"], found["distinct"]) == (20, 0.0, 19.0, 20)

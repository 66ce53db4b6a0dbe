"""Exact percentiles of large, tied and odd groups, and the plan that finds them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import stats


def test_large_groups_with_ties_and_odd_values(spark):
    rng = np.random.default_rng(7)
    groups = {
        "large": rng.normal(size=60_000) * 10.0 ** rng.integers(-3, 6, 60_000), "tied": rng.integers(0, 4, 50_000).astype(float), "same": np.full(30_000, 2.5),
        "skewed": np.concatenate([np.zeros(45_000), rng.exponential(size=500) * 1e9]), "one": np.array([7.0]), None: rng.normal(size=50), "odd": np.array([np.nan, 1.0, 2.0, np.inf, -np.inf]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("large", None), ("empty", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    points = (0.0, 0.01, 0.25, 0.5, 0.95, 0.99, 1.0)
    found = {r["g"]: r["_p"] for r in stats.exact_percentiles(df, "g", F.col("v"), points).collect()}
    assert found.keys() == groups.keys()
    for g, vs in groups.items():
        if g != "odd":
            assert np.allclose(found[g], np.quantile(vs, points), rtol=1e-12, atol=1e-12)
    assert found["odd"][0] == -np.inf and found["odd"][-1] == np.inf


def test_whole_numbers(spark):
    df = spark.range(1001).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    assert stats.exact_percentiles(df, "g", F.col("v"), (0.5, 0.999)).first()["_p"] == pytest.approx([500, 999])


def test_the_source_is_read_once_and_no_job_runs_before_the_action(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    df = stats.describe_groups(source, "g", "v")
    assert set(tracker.getJobIdsForGroup()) == before
    assert {r["n"] for r in df.collect()} == {333, 334}
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan

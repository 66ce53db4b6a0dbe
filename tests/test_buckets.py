"""Tables that batches rewrite in part, and the view that three jobs keep up to date."""

import os
import re

import pytest

from ledgerline.operators import periods
from ledgerline.sources.buckets import BucketTable
from ledgerline.streaming import maintenance

SCHEMA = "k long, v string, t int"


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def held(spark, tmp_path):
    t = BucketTable(str(tmp_path / "t"), ("k",), 8)
    t.upsert(spark.createDataFrame([(k, f"a{k}", 1) for k in range(50)], SCHEMA), ["k"], ["t"])
    return t


def _rows(spark, t):
    return sorted(map(tuple, t.read(spark).collect()))


def test_a_batch_rewrites_the_buckets_that_it_touches(spark, held):
    before = _files(held.path)
    touched = held.upsert(spark.createDataFrame([(3, "b3", 2), (60, "b60", 2), (4, "old", 0)], SCHEMA), ["k"], ["t"])
    after = _files(held.path)
    assert 0 < len(touched) < 8
    in_touched = re.compile("bucket=(" + "|".join(map(str, touched)) + ")/")
    assert {f: m for f, m in before.items() if not in_touched.search(f)} == {f: m for f, m in after.items() if not in_touched.search(f)}
    assert not {f for f in before if in_touched.search(f)} & after.keys()
    assert _rows(spark, held) == sorted([(k, "b3" if k == 3 else f"a{k}", 2 if k == 3 else 1) for k in range(50)] + [(60, "b60", 2)])


def test_a_batch_again_changes_nothing(spark, held):
    batch = spark.createDataFrame([(3, "b3", 2), (3, "c3", 3), (None, "n", 1)], SCHEMA)
    held.upsert(batch, ["k"], ["t"])
    once = sorted(map(str, held.read(spark).collect()))
    held.upsert(batch, ["k"], ["t"])
    held.upsert(batch.limit(0), ["k"], ["t"])
    assert sorted(map(str, held.read(spark).collect())) == once
    assert len(once) == 51


def test_other_merges(spark, held):
    held.insert_new(spark.createDataFrame([(3, "x", 2), (70, "y", 2), (70, "x", 1)], SCHEMA), ["k"], ["t"])
    assert [r for r in _rows(spark, held) if r[0] in (3, 70)] == [(3, "a3", 1), (70, "x", 1)]
    held.replace_groups(spark.createDataFrame([(3, "p", 5), (3, "q", 6)], SCHEMA), "k")
    assert [r for r in _rows(spark, held) if r[0] == 3] == [(3, "p", 5), (3, "q", 6)]
    with pytest.raises(ValueError):
        held.replace_groups(spark.createDataFrame([(3, "p", 5)], SCHEMA), "v")


def test_a_replacement_that_died_is_ended(spark, held, monkeypatch):
    """A run dies after it has staged its buckets; the next run, of any batch, replaces them first."""
    monkeypatch.setattr(BucketTable, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        held.upsert(spark.createDataFrame([(3, "b3", 2)], SCHEMA), ["k"], ["t"])
    monkeypatch.undo()
    assert (3, "a3", 1) in _rows(spark, held)  # readers don't see what is staged
    held.upsert(spark.createDataFrame([(5, "b5", 2)], SCHEMA), ["k"], ["t"])
    assert [r for r in _rows(spark, held) if r[0] in (3, 5)] == [(3, "b3", 2), (5, "b5", 2)]
    assert not os.path.exists(f"{held.path}/_staged")


FACT = "entity string, concept string, seq int, start date, end date, val double, filed date"


def _facts(spark, entities, year, value):
    import datetime as dt

    return spark.createDataFrame([(e, "c", year, dt.date(year, 1, 1), dt.date(year, 12, 31), value, dt.date(year + 1, 2, 1)) for e in entities], FACT)


def test_batches_equal_a_full_run_and_other_entities_are_not_read(spark, tmp_path):
    import datetime as dt

    jobs = maintenance.Jobs(spark, str(tmp_path), buckets=8)
    names = [f"e{k}" for k in range(40)]
    quote = lambda es, d, p: spark.createDataFrame([(e, dt.date(2024, 1, d), p) for e in es], "entity string, day date, price double")
    jobs.load_financials(_facts(spark, names, 2022, 10.0))
    jobs.load_quotes(quote(names, 1, 100.0))
    assert len(jobs.refresh()) == 8
    assert jobs.refresh() == []  # nothing changed
    before = _files(jobs.view.path)
    jobs.load_financials(_facts(spark, names[:1], 2023, 20.0))
    changed, _ = jobs.changes()
    facts, _ = jobs.inputs(changed)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    bucket = jobs.facts.touched(changed)
    assert re.search(rf"PartitionFilters: \[.*bucket#\d+ (= {bucket[0]}|IN \({bucket[0]}\))", plan)
    assert {r["entity"] for r in facts.collect()} == {"e0"}
    assert jobs.refresh() == bucket
    kept = {f: m for f, m in before.items() if f"bucket={bucket[0]}/" not in f}
    assert kept and kept.items() <= _files(jobs.view.path).items()
    jobs.load_quotes(quote(["e1", "new"], 2, 50.0))
    jobs.refresh()
    one = sorted(map(str, jobs.view.read(spark).collect()))
    whole = maintenance.latest_values(jobs.facts.read(spark), jobs.quotes.read(spark))
    assert one == sorted(map(str, whole.select(*jobs.view.read(spark).columns).collect()))
    found = {r["entity"]: (r["value"], r["price"], r["multiple"]) for r in jobs.view.read(spark).collect()}
    assert (found["e0"], found["e1"], found["e2"]) == ((20.0, 100.0, 5.0), (10.0, 50.0, 5.0), (10.0, 100.0, 10.0))
    jobs.refresh(everything=True)
    assert sorted(map(str, jobs.view.read(spark).collect())) == one
    assert periods.KEYS[0] == "entity"

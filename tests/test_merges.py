"""Registered queries see the whole table, and their merges meet rows that are already there."""

import os

import pytest

from ledgerline.plans import registry
from ledgerline.sources import sinks

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_props_of_every_event_are_parsed(spark):
    found = registry.queries()["op_s6_f26_all"](spark, SF)
    assert found.count() == found.filter("k is not null").count() == spark.read.parquet(f"{SF}/events.parquet").count()


@pytest.mark.parametrize("name, mode", [("op_w1", "upsert"), ("op_w2", "insert_new")])
def test_a_merge_meets_existing_rows(spark, monkeypatch, name, mode):
    calls, real = [], getattr(sinks, mode)

    def spy(existing, incoming, keys, order):
        calls.append((existing, incoming, keys))
        return real(existing, incoming, keys, order)

    monkeypatch.setattr(sinks, mode, spy)
    registry.queries()[name](spark, SF)
    existing, incoming, keys = calls[-1]
    here, there = ({tuple(r) for r in x.select(*keys).distinct().collect()} for x in (existing, incoming))
    assert here & there
    assert sum(c[1].count() for c in calls) == spark.read.parquet(f"{SF}/events.parquet").count()

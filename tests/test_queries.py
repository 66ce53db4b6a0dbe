"""Every query of the core against its SQL, on the small tables."""

import math
import os

import duckdb
import pytest

from ledgerline.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def _rows(rows):
    return sorted((tuple(list(x) if isinstance(x, list) else x for x in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def _same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, (int, float)) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    found = registry.queries()[name](spark, SF)
    wanted = tables.sql(registry.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    columns = sorted(found.columns)
    a = _rows(found.select(*columns).collect())
    b = _rows(wanted.select(*[f'"{c}"' for c in columns]).fetchall())
    assert len(a) == len(b)
    assert all(_same(x, y) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


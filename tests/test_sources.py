"""Readers, write modes and incremental runs on small files."""

import json

import pytest

from ledgerline.sources import readers, sinks
from ledgerline.streaming import incremental


def test_company_facts(spark):
    point = {"end": "2024-12-31", "val": 1.0, "form": "10-K", "filed": "2025-02-01"}
    doc = {"us-gaap": {"Revenues": {"units": {"USD": [point, point | {"val": None}, point | {"form": "8-K"}, point | {"end": "2010-12-31"}, point | {"end": None}]}}}, "dei": {"X": {"units": {"USD": [point]}}}}
    df = spark.createDataFrame([("1", json.dumps(doc))], "cik string, facts string")
    assert sorted(r["seq"] for r in readers.company_facts(df, "2025-06-30").collect()) == [0, 4]


def test_columnar_json_and_html_rows(spark):
    df = spark.createDataFrame([('{"fields": ["cik", "ticker"], "data": [["1", "A"], ["2", "B"]]}',)], "j string")
    assert [(r["ticker"], r["cik"]) for r in readers.columnar_json(df, "j", ["ticker", "cik"]).collect()] == [("A", "1"), ("B", "2")]
    page = spark.createDataFrame([(1, "<table><tr><th>a</th><td> <b>x</b></td></tr></table>")], "id int, html string")
    assert readers.html_tables(page, "id", "html").first()["cells"] == ["a", "x"]


def test_sheet_and_prices(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("Ticker;PER;Año\nA;1;2\nB;3;4\n".encode("iso-8859-1"))
    assert readers.read_sheet(spark, str(tmp_path / "s.csv"), 2, 5, ["ticker"], 3).count() == 3
    with pytest.raises(ValueError):
        readers.read_sheet(spark, str(tmp_path / "s.csv"), 2, 5, ["ticker"], 9)
    (tmp_path / "p.json").write_text(json.dumps({"timestamp": "t", "precios": {"A": {"last_price": 1.5}, "B": {"last_price": None}}}))
    assert {r["ticker"]: r["last_price"] for r in readers.read_prices(spark, str(tmp_path / "p.json")).collect()} == {"A": 1.5, "B": None}


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "k int, x string, y int")
    new = spark.createDataFrame([(2, "b", 9), (3, "c", 3)], "k int, x string, y int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(sinks.upsert(old, new, ["k"])) == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    assert [r[0] for r in rows(sinks.insert_new(old.fillna("z"), new, ["k"], ["y"]))] == [1, 2, 3]
    assert rows(sinks.update_missing(old, new, ["k"], ["x"])) == [(1, "a", 1), (2, "b", 9)]
    assert rows(sinks.replace_groups(old.fillna("z"), new, "k")) == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]


def test_checked_write_refuses_what_lacks_its_sentinel(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "t")
    assert sinks.checked_write(df, path, "id = 4") == 5
    assert sinks.checked_write(spark.range(7), path, "id = 6") == 7
    with pytest.raises(ValueError):
        sinks.checked_write(df, path, "id = 99")
    assert spark.read.parquet(path).count() == 7


def test_stream_of_files_keeps_the_latest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.run_upserts(spark, str(tmp_path / "in"), "k int, v int, at int", str(tmp_path / "out"), ["k"], ["at"], str(tmp_path / "cp"))
    (tmp_path / "in/1.json").write_text('{"k":1,"v":1,"at":1}\n{"k":2,"v":1,"at":1}\n')
    run()
    (tmp_path / "in/2.json").write_text('{"k":1,"v":2,"at":2}\n{"k":2,"v":0,"at":0}\n')
    run()
    assert {r["k"]: r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: 2, 2: 1}

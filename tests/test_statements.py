"""Statement text: amounts, codes, scales and file names, by hand."""

import pytest

from ledgerline.functions import statements as S

NAMES = [
    ("EEFF 3T 2021.pdf", 12, (2021, 9, "trimestral")), ("balance_2º trimestre_2020", 12, (2020, 6, "trimestral")), ("Q1-2022", 12, (2022, 3, "trimestral")),
    ("4T2019", 12, (2019, 12, "anual")), ("1 trim. 2020", 6, (2020, 9, "trimestral")), ("trimestre 2 2020 - 2019", 12, (2020, 6, "trimestral")),
    ("eeff_31.03.2021_2022.pdf", 12, (2022, 3, "trimestral")), ("30/06/2021", 6, (2021, 6, "anual")), ("memoria anual septiembre 2020", 12, (2020, 9, "anual")),
    ("Balance junio", 12, (None, 6, "trimestral")), ("estados 2018", 12, (2018, None, "anual")), ("", 12, (None, None, "anual")), ("15T 2020", 12, (2020, None, "anual")),
    ("extracto 3 total 2020", 12, (2020, None, "anual")), ("31122023", 12, (2023, None, "anual")),
]


@pytest.mark.parametrize("name, close, wanted", NAMES)
def test_file_names(name, close, wanted):
    assert S.period_of(name, close) == wanted


AFTER = [
    ("Revenue 1,000 (2,000,000)", (1000.0, -2000000.0)), ("Revenue (note 4): 1,000.5 -2,500", (1000.5, -2500.0)), ("Revenue 12 13", None), ("Revenue\n1,000 2,000", None),
    ("Revenue 1,00 2,000", None), ("Revenue " + "x" * 40 + " 1,000 2,000", None), ("Revenue 7 1,000 2,000 3,000", (1000.0, 2000.0)), ("Revenue then Revenue 1,000 2,000", (1000.0, 2000.0)), ("", None), (None, None),
]


def test_two_numbers(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(AFTER)], "k int, t string")
    found = df.select("k", S.two_numbers("t", ["Revenue"], 10).alias("f")).orderBy("k").collect()
    assert [r["f"] and tuple(r["f"]) for r in found] == [w and (w[0] * 10, w[1] * 10) for _, w in AFTER]


def test_code_amounts(spark):
    text = "1000001 ACTIVO (TOTAL) 5.25 1000001 OTRA VEZ 7.00 9000001 NADA 1.00 2000002 PASIVO NO\nCORRIENTE -3.50 3000003 minúsculas 4.00 4000004 5.00 5000005 X 6.0"
    found = spark.createDataFrame([(text,), (None,)], "t string").select(S.code_amounts("t").alias("c")).collect()
    assert [[tuple(x) for x in r["c"]] for r in found] == [[("1000001", 5.25), ("2000002", -3.5)], []]


def test_scale_and_kind(spark):
    texts = [("Expressed in THOUSANDS", 1000, "A"), ("miles de pesos, three-month period", 1000, "Q"), ("millions of millas", 1_000_000, "A"), ("x" * 8000 + "in thousands", 1, "A"), ("", 1, "A")]
    found = spark.createDataFrame(texts, "t string, s int, k string").select("s", "k", S.scale_of("t").alias("scale"), S.period_kind("t").alias("kind")).collect()
    assert all(r["s"] == r["scale"] and r["k"] == r["kind"] for r in found)

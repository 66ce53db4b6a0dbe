"""Tables of pages as grids, rules by one automaton, names by q-grams: against plain re-statements."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.functions import rules
from ledgerline.operators import similarity
from ledgerline.sources import readers, tables


def _cells(html):
    return [(t.no, t.parent, c.row, c.col, c.rows, c.cols, tables._text(c)) for t in tables.PageTables.of(html).tables for c in t.cells]


def test_a_nested_table_loses_no_cell():
    html = "<table><tr><td>a<td>b <table><tr><td>x<td>y</table> c<td>d</table>"
    assert _cells(html) == [(0, None, 0, 0, 1, 1, "a"), (0, None, 0, 1, 1, 1, "b c"), (0, None, 0, 2, 1, 1, "d"), (1, 0, 0, 0, 1, 1, "x"), (1, 0, 0, 1, 1, 1, "y")]


def test_rows_flow_around_spans():
    html = "<table><thead><tr><th rowspan=3>h<th colspan=2>i</thead><tbody><tr><td rowspan=2>a<td>b<tr><td>c<td rowspan=0>z<tr><td>d<td>e</table><p>x"
    assert _cells(html) == [(0, None, 0, 0, 1, 1, "h"), (0, None, 0, 1, 1, 2, "i"), (0, None, 1, 0, 2, 1, "a"), (0, None, 1, 1, 1, 1, "b"), (0, None, 2, 1, 1, 1, "c"), (0, None, 2, 2, 2, 1, "z"), (0, None, 3, 0, 1, 1, "d"), (0, None, 3, 1, 1, 1, "e")]


@pytest.mark.parametrize("html", [None, "", "<td>no table", "<table>", "</table></tr>", "<table><td>x", "<table><tr><td>1<script>'<td>'</script></td></table", "<table><tr><td colspan=99999 rowspan=x>w</table>"])
def test_odd_pages(html):
    found = _cells(html)
    assert len(found) == (html is not None and html.startswith("<table><t"))
    assert all(c[5] <= tables.MOST_COLUMNS for c in found)


def test_grids_by_brute_force():
    """Random rectangles laid out as HTML: every cell comes back where it was."""
    rnd = random.Random(8)
    for _ in range(200):
        rows, cols = rnd.randrange(1, 7), rnd.randrange(1, 7)
        grid, wanted = [[None] * cols for _ in range(rows)], []
        html = "<table>"
        for r in range(rows):
            html += rnd.choice(["<tr>", "<TR class=x>"])
            for c in range(cols):
                if grid[r][c] is None:
                    w = rnd.randrange(1, 4)
                    while any(c + k >= cols or grid[r][c + k] is not None for k in range(w)):
                        w -= 1
                    h = rnd.randrange(1, rows - r + 1)
                    for x in range(r, r + h):
                        for y in range(c, c + w):
                            grid[x][y] = len(wanted)
                    html += f"<td rowspan={h} colspan='{w}'>{len(wanted)}" + rnd.choice(["", "</td>"])
                    wanted.append((r, c, h, w, str(len(wanted))))
            html += rnd.choice(["", "</tr>"])
        assert [x[2:] for x in _cells(html + "</table>")] == wanted


def test_tables_in_spark(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td rowspan=2>a<td>b<tr><td>c</table><table></table>", 0), (2, None, 0), (3, "<script></script>", 0)], "id int, html string, text int")
    assert [tuple(r) for r in tables.table_rows(pages, "id", "html").collect()] == [(1, 0, 0, ["a", "b"]), (1, 1, 0, ["a", "c"])]
    assert [r["cells"] for r in readers.html_tables(pages, "id", "html").collect()] == [["a", "b"], ["a", "c"]]
    assert sorted(tuple(r) for r in tables.page_structure(pages, "id", "html").collect()) == [(1, 2, 2, 2, 0), (2, 0, 0, 0, 0), (3, 0, 0, 0, 1)]
    assert tables.table_cells(pages, "id", "html").count() == 3


NAMES = ["Banco", "BANCOR", "El banco.", "banco_x", "x S.A.", "x S.A", "xS.A.", "S.Ax", "S.A.x", "AVAL SGR", "sgrx", "Fondo banco", "Valores del mercado", "", None, "pymes", "GARANTIA RECIPROCA", "fci", "fcis"]


def test_first_rule_as_patterns_find_it(spark):
    def pattern(w):
        return (r"\b" if w.before else "") + re.escape(w.text) + (r"\b" if w.after else "")

    rnd = random.Random(2)
    names = NAMES + ["".join(rnd.choice(["BANCO", "SGR", "S.A.", " ", ".", "x", "FONDO", "FCI", "_"]) for _ in range(5)) for _ in range(300)]
    wanted = []
    for n in names:
        hit = next((r for r in rules.ENTITY_RULES if n is not None and any(re.search(pattern(w), n.upper()) for w in r.words)), None)
        wanted.append((n, hit.label if hit else "Sin clasificar", hit.score if hit else 0))
    found = spark.createDataFrame([(n,) for n in names], "name string").select("name", rules.classified("name").alias("r")).select("name", "r.*")
    assert list(map(tuple, found.collect())) == wanted
    assert {w[1] for w in wanted} > {"Banco", "Empresa S.A.", "Sociedad de Garantía Recíproca"}


def test_keywords_as_before(spark):
    names = [("Memoria y balance",), ("ACTA",), (None,), ("otros",), ("información financiera",)]
    df = spark.createDataFrame(names, "x string")
    one = df.select(rules.keyword_classified("x", C.STATEMENT_FORMS, C.OTHER_FORMS).alias("k"))
    assert [r.k for r in one.collect()] == [r.k for r in df.select(C.keyword_class("x", C.STATEMENT_FORMS, C.OTHER_FORMS).alias("k")).collect()]


def test_matching_lines(spark):
    texts = ["El  TIPO \tde\r\nnada\n\nSector: x\nRÉGIMEN\nti\npo", "", None, "İtipo\nx\nİ", "a\n" * 3 + "acciones y bolsa"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(rules.matching_lines("t").alias("l")).collect()
    assert [r.l for r in found] == [["El TIPO de", "Sector: x", "RÉGIMEN"], [], [], ["İtipo"], ["acciones y bolsa"]]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for k, y in enumerate(b):
            row.append(last[k] + 1 if x == y else max(row[-1], last[k + 1]))
    return row[-1]


def test_bit_parallel_rows():
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rnd.choice("abcde") for _ in range(rnd.randrange(90))) for _ in range(2))
        assert similarity.lcs(a, b) == _lcs(a, b)


@pytest.mark.parametrize("percent", [70.0, 85.0, 100.0])
def test_similar_names_equal_all_pairs(spark, percent):
    rnd = random.Random(6)
    base = [" ".join("".join(rnd.choice(string.ascii_lowercase[:9]) for _ in range(rnd.randrange(1, 8))) for _ in range(rnd.randrange(1, 4))) for _ in range(60)] + ["a", "ab", "b a", "", "aa", "aab"]

    def slip(x):
        w = list(x)
        for _ in range(rnd.randrange(3)):
            if w:
                w[rnd.randrange(len(w))] = rnd.choice(["", "x", "ab"])
        w = "".join(w).split()
        rnd.shuffle(w)
        return rnd.choice([str.upper, str.lower])("  ".join(w))

    left = [(k, x) for k, x in enumerate(base)] + [(900, None), (901, base[0])]
    right = [(k, slip(x)) for k, x in enumerate(base + base)] + [(900, None)]
    norm = lambda x: " ".join(sorted(x.lower().split()))
    wanted = {}
    for i, a in left:
        for j, b in right:
            if a is not None and b is not None:
                x, y = norm(a), norm(b)
                score = 200 * _lcs(x, y) / (len(x) + len(y)) if x or y else 100.0
                if score >= percent - 1e-9:
                    wanted[i, j] = score
    dl, dr = spark.createDataFrame(left, "l int, a string"), spark.createDataFrame(right, "r int, b string")
    found = similarity.similar_names(dl, dr, "a", "b", percent)
    assert {(r["l"], r["r"]): pytest.approx(r["score"]) for r in found.collect()} == wanted
    best = {r["l"]: r["r"] for r in similarity.best_names(dl, dr, "l", "a", "b", "r", percent).collect()}
    assert best == {i: min((j for x, j in wanted if x == i and abs(wanted[i, j] - max(s for (y, _), s in wanted.items() if y == i)) < 1e-9), default=None) for i, _ in left}
    if percent == 85:
        texts = dl.select(F.lower("a").alias("_name")).dropna().distinct(), dr.select(F.lower("b").alias("_name")).dropna().distinct()
        assert similarity.candidates(*texts, 85.0).count() < 0.5 * texts[0].count() * texts[1].count()
    with pytest.raises(ValueError):
        similarity.similar_names(dl, dr, "a", "b", 60.0)

"""Queries over tables of pages, rule sets of words, and names that are alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.functions import rules
from ledgerline.functions import statements as S
from ledgerline.operators import similarity
from ledgerline.plans.base import query
from ledgerline.session import table
from ledgerline.sources import tables


@query("""WITH p AS (SELECT CAST(p_partkey % 50 AS INTEGER) AS page, p_partkey AS k, p_name, p_brand, p_type, p_size, CAST(row_number() OVER (PARTITION BY p_partkey % 50 ORDER BY p_partkey) AS INTEGER) AS n FROM part),
c AS (SELECT page, 0 AS table_no, NULL::INTEGER AS parent, 2 * n - 2 AS row_no, 0 AS col_no, 2 AS rowspan, 1 AS colspan, true AS header, k::VARCHAR AS text FROM p
UNION ALL SELECT page, 0, NULL, 2 * n - 2, 1, 1, 1, false, p_name FROM p
UNION ALL SELECT page, 0, NULL, 2 * n - 2, 2, 1, 1, false, 'before ' || p_size || ' after' FROM p
UNION ALL SELECT page, 0, NULL, 2 * n - 1, 1, 1, 2, false, '2 x ' || k FROM p
UNION ALL SELECT page, n, 0, 0, 0, 1, 1, false, p_brand FROM p
UNION ALL SELECT page, n, 0, 0, 1, 1, 1, false, p_type FROM p)
SELECT page, CAST(table_no AS INTEGER) AS table_no, parent, CAST(row_no AS INTEGER) AS row_no, col_no, rowspan, colspan, header, text FROM c""")
def op_s9_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty pages of one table each, with a nested table in every second row and cells that span rows and columns."""
    k = F.col("p_partkey").cast("string")
    row = F.concat(
        F.lit("<TR><th rowspan=2>"), k, F.lit("</th><td class='tr td'><b>"), "p_name", F.lit("</b><td>before <table><tr><td>"), "p_brand", F.lit("<td>"), "p_type",
        F.lit("</table>\n"), F.col("p_size").cast("string"), F.lit(" after</td></tr><tr><td colspan='2'>2 &#120; "), k, F.lit("</tr>"),
    )
    held = table(spark, sf, "part").groupBy((F.col("p_partkey") % 50).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("row")))).alias("rows"))
    pages = held.select("page", F.concat(F.lit("<p>x<script>'<td>'</script><table><tbody>"), F.array_join(F.col("rows.row"), ""), F.lit("</table>")).alias("html"))
    return tables.table_cells(pages, "page", "html")


@query("SELECT page_id, len(regexp_extract_all(html, '(?i)<table\\b'))::INTEGER AS tables, len(regexp_extract_all(html, '(?i)<tr\\b'))::INTEGER AS rows, len(regexp_extract_all(html, '(?i)<script\\b'))::INTEGER AS scripts FROM pages")
def op_f21_pages(spark: SparkSession, sf: str) -> DataFrame:
    return tables.page_structure(table(spark, sf, "pages"), "page_id", "html").select("page_id", "tables", "rows", "scripts")


_ADDRESS = {"action": r'(?i)action="([^"]+)"', "href": r'(?i)href="([^"]+)"', "src": r'(?i)src="([^"]+)"', "aif2": r"(?i)(aif2)", "function": r"(function\s+[A-Za-z0-9_]+)"}


@query("WITH p AS (SELECT page_id, html || '<form action=\"/aif2/x' || page_id || '\">function  go' || page_id % 7 AS h FROM pages), f AS ("
    + " UNION ALL ".join(f"SELECT page_id, '{n}' AS name, regexp_extract_all(h, '{x}', 1) AS found FROM p" for n, x in _ADDRESS.items())
    + " UNION ALL SELECT page_id, 'controller', list_sort(list_distinct(regexp_extract_all(h, '/([A-Za-z]+)/[A-Za-z0-9_\\-]+', 1))) FROM p) SELECT * FROM f WHERE len(found) > 0")
def op_f22_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Form targets, links, sources and the like of every page, with a form and a function more."""
    more = F.concat(F.lit('<form action="/aif2/x'), F.col("page_id").cast("string"), F.lit('">function  go'), (F.col("page_id") % 7).cast("string"))
    found = table(spark, sf, "pages").select("page_id", F.explode(S.page_addresses(F.concat("html", more))).alias("f"))
    return found.select("page_id", "f.*").filter(F.size("found") > 0)


# names of every kind, and some that only look like one
_ENDINGS = ("Avales SGR", "Garantia Reciproca", "FCI Renta", "Fondos", "Fideicomiso Uno", "Banco", "Bancor", "Aseguradora", "Mercados", "Broker", "Gerente", "Pymes", "Cooperativa Ltda", "S.A.", "S.A", "SRL", "XSGRX", "Seguros y Fondos", "S.Ax")
_NAMED = f"SELECT c_custkey, c_name || ' ' || [{', '.join(repr(x) for x in _ENDINGS)}][1 + c_custkey % {len(_ENDINGS)}] AS name FROM customer"
_PATTERNS = {
    "Sociedad de Garantía Recíproca": r"\bSGR\b|GARANTIA RECIPROCA", "Fondo Común de Inversión": r"FONDO|\bFCI\b", "Fideicomiso": "FIDEICOMISO", "Banco": r"\bBANCO\b", "Aseguradora": "SEGUROS|ASEGURAD", "Mercado": "MERCADO",
    "ALyC / Valores": "VALORES|SECURITIES|BROKER", "Sociedad Gerente": "GERENTE", "PyME": "PYME", "Cooperativa": "COOPERATIVA", "Empresa S.A.": r"\bS\.A\b|\bS\.A\.",
}
_SCORES = {"ALyC / Valores": 95, "PyME": 90, "Empresa S.A.": 70}


@query(f"WITH n AS ({_NAMED}) SELECT c_custkey, CASE " + " ".join(f"WHEN regexp_matches(upper(name), '{p}') THEN '{x}'" for x, p in _PATTERNS.items()) + " ELSE 'Sin clasificar' END AS label, CASE " + " ".join(f"WHEN regexp_matches(upper(name), '{p}') THEN {_SCORES.get(x, 100)}" for x, p in _PATTERNS.items()) + " ELSE 0 END AS score FROM n")
def op_p16_all_rules(spark: SparkSession, sf: str) -> DataFrame:
    ending = F.element_at(F.array(*map(F.lit, _ENDINGS)), (F.col("c_custkey") % len(_ENDINGS) + 1).cast("int"))
    named = table(spark, sf, "customer").select("c_custkey", F.concat_ws(" ", "c_name", ending).alias("name"))
    return named.select("c_custkey", rules.classified("name").alias("r")).select("c_custkey", "r.label", "r.score")


_FORMS = (*C.STATEMENT_FORMS, *C.OTHER_FORMS)


@query(f"WITH f AS (SELECT p_partkey, lower([{', '.join(repr(x) for x in _FORMS)}][1 + p_partkey % {len(_FORMS)}]) || ' ' || [{', '.join(repr(x) for x in _FORMS)}][1 + p_partkey // 7 % {len(_FORMS)}] || p_name AS name FROM part) SELECT p_partkey, CASE WHEN regexp_matches(upper(name), '{'|'.join(C.STATEMENT_FORMS)}') THEN 1 WHEN regexp_matches(upper(name), '{'|'.join(C.OTHER_FORMS)}') THEN 0 END AS is_statement FROM f")
def op_p17_all_words(spark: SparkSession, sf: str) -> DataFrame:
    """Form names of two of the words each, one in lower case."""
    form = lambda k: F.element_at(F.array(*map(F.lit, _FORMS)), (k % len(_FORMS) + 1).cast("int"))
    name = F.concat(F.lower(form(F.col("p_partkey"))), F.lit(" "), form(F.floor(F.col("p_partkey") / 7)), "p_name")
    return table(spark, sf, "part").select("p_partkey", rules.keyword_classified(name, C.STATEMENT_FORMS, C.OTHER_FORMS).alias("is_statement"))


_LINES = f"coalesce(text, '') || chr(10) || '  ' || [{', '.join(repr(x) for x in rules.LINE_WORDS)}][1 + doc_id % {len(rules.LINE_WORDS)}] || ':   ' || doc_id || chr(10) || upper([{', '.join(repr(x) for x in rules.LINE_WORDS)}][1 + doc_id // 5 % {len(rules.LINE_WORDS)}])"


@query(rf"""WITH t AS (SELECT doc_id, {_LINES} AS t FROM documents), l AS (SELECT doc_id, unnest(regexp_split_to_array(t, '\r\n|[\n\r\x0b\x0c\x1c-\x1e]')) AS line, generate_subscripts(regexp_split_to_array(t, '\r\n|[\n\r\x0b\x0c\x1c-\x1e]'), 1) AS n FROM t),
m AS (SELECT doc_id, n, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line FROM l WHERE regexp_matches(lower(line), '{'|'.join(rules.LINE_WORDS)}'))
SELECT doc_id, list(line ORDER BY n) AS lines FROM m WHERE length(line) >= 3 GROUP BY 1""")
def op_f23_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines with one of the words, of every text and two lines more."""
    word = lambda k: F.element_at(F.array(*map(F.lit, rules.LINE_WORDS)), (k % len(rules.LINE_WORDS) + 1).cast("int"))
    more = F.concat(F.lit("\n  "), word(F.col("doc_id")), F.lit(":   "), F.col("doc_id").cast("string"), F.lit("\n"), F.upper(word(F.floor(F.col("doc_id") / 5))))
    text = F.concat(F.coalesce("text", F.lit("")), more)
    return table(spark, sf, "documents").select("doc_id", rules.matching_lines(text).alias("lines")).filter(F.size("lines") > 0)


def op_c8_names(spark: SparkSession, sf: str) -> DataFrame:
    """Each part's name, type and brand with the most similar description that the catalogue has: words in another order, some with a slip."""
    part = table(spark, sf, "part")
    wanted = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("description"))
    slip = lambda x: F.when(F.col("p_partkey") % 3 == 0, F.replace(x, F.lit("i"), F.lit("ie"))).otherwise(x)
    catalogue = part.groupBy(slip(F.concat_ws("  ", "p_brand", "p_type", "p_name")).alias("entry")).agg(F.min("p_partkey").alias("entry_id"))
    return similarity.best_names(wanted, catalogue, "p_partkey", "description", "entry", "entry_id", 95.0)


query()(op_c8_names)

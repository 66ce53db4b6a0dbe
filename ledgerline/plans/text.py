"""Queries over statement text. Their texts are made from part keys by one rule, so the SQL knows
the values that have to be found without reading the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.functions import statements as S
from ledgerline.plans.base import query
from ledgerline.session import table



def _parts(spark: SparkSession, sf: str, **texts: Column) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k")).withColumns(texts)


def _say(*parts) -> Column:
    """Text of strings and numbers."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _k() -> Column:
    return F.col("k")


@query("SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN -(p_partkey * 1000 + 0.5) WHEN 1 THEN -(p_partkey * 1000 + 0.25) END::DOUBLE AS value FROM part")
def op_f6(spark: SparkSession, sf: str) -> DataFrame:
    thousands = F.format_number(F.col("k") * 1000, 0)
    text = F.when(_k() % 3 == 0, _say("(", thousands, ".5)")).when(_k() % 3 == 1, _say("-", thousands, ".25")).otherwise("n/a")
    return _parts(spark, sf, text=text).select("k", C.english_number("text").alias("value"))


@query("SELECT p_partkey AS k, 'Total ' || p_partkey || '000.5 of 7 lines' AS joined FROM part")
def op_f8(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, text=_say("Total ", _k(), " 000 .5 of 7 lines")).select("k", C.joined_numbers("text").alias("joined"))


@query("SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN -(p_partkey + 0.5) WHEN 1 THEN p_partkey * 1000 END::DOUBLE AS value FROM part")
def op_f9(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(_k() % 3 == 0, _say("Total pasivo 9 PATRIMONIO NETO $ (", _k(), ",5)")).when(_k() % 3 == 1, _say("Activo total: ", _k(), ".000 pesos")).otherwise(_say("Patrimonio neto sin dato; ver nota adjunta de los auditores ", _k()))
    return _parts(spark, sf, text=text).select("k", C.label_number("text", ["patrimonio neto", "activo total"]).alias("value"))


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 3 < 2 THEN (1000000 + p_partkey) * 1000 END::DOUBLE AS current, CASE WHEN p_partkey % 3 < 2 THEN -(2000000 + p_partkey) * 1000 END::DOUBLE AS comparative FROM part")
def op_f10(spark: SparkSession, sf: str) -> DataFrame:
    amounts = (" ", F.format_number(_k() + 1_000_000, 0), "  (", F.format_number(_k() + 2_000_000, 0), ") and notes 12")
    text = F.when(_k() % 3 == 0, _say("Revenue of the period", *amounts)).when(_k() % 3 == 1, _say("Net sales (note 4)", *amounts)).otherwise("Revenue: 12 and 13")
    found = S.two_numbers("text", ["Revenue", r"Net sales"], 1_000)
    return _parts(spark, sf, text=text).select("k", found.alias("f")).select("k", "f.current", "f.comparative")


@query("SELECT p_partkey AS k, code, amount FROM part, (VALUES ('1000001', 1), ('2000002', 2)) c(code, n), LATERAL (SELECT (CASE n WHEN 1 THEN p_partkey + 0.25 ELSE -(p_partkey + 0.5) END)::DOUBLE AS amount) WHERE n = 1 OR p_partkey % 2 = 0")
def op_f11(spark: SparkSession, sf: str) -> DataFrame:
    second = F.when(_k() % 2 == 0, _say(" 2000002 PASIVO NO CORRIENTE -", _k(), ".50")).otherwise("")
    text = _say("1000001 ACTIVO (TOTAL) ", _k(), ".25", second, " 1000001 ACTIVO OTRA VEZ 7.00 9000001 NADA 1.00")
    return _parts(spark, sf, text=text).select("k", F.explode(S.code_amounts("text")).alias("c")).select("k", "c.code", "c.amount")


@query("""SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 ELSE 1 END::INTEGER AS scale,
CASE WHEN p_partkey % 20 < 15 THEN CAST(2013 + p_partkey % 20 AS VARCHAR) || '-03-09' ELSE '2016-12-31' END AS "end", CASE p_partkey % 2 WHEN 0 THEN 'Q' ELSE 'A' END AS kind FROM part WHERE p_partkey % 20 >= 4""")
def op_f16_f17(spark: SparkSession, sf: str) -> DataFrame:
    year = (F.col("k") % 20 + 2013).cast("int")
    size = F.when(_k() % 3 == 0, "Expressed in thousands").when(_k() % 3 == 1, "En MILLONES DE pesos").otherwise("In full")
    text = _say(size, F.when(_k() % 2 == 0, ", for the three-month period").otherwise(", for the year"), " ended March 9, ", year, " and DECEMBER 31 2016, May 40, 2020")
    rows = _parts(spark, sf, text=text).filter("k % 20 >= 4")
    return rows.select("k", S.scale_of("text").alias("scale"), S.period_end("text").alias("end"), S.period_kind("text").alias("kind"))


@query("""SELECT p_partkey AS k, (2010 + p_partkey % 15)::INTEGER AS year, CASE p_partkey % 5 WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 2 THEN 9 WHEN 3 THEN 12 END::INTEGER AS month,
CASE WHEN p_partkey % 5 < 3 THEN 'trimestral' ELSE 'anual' END AS kind FROM part""")
def op_f18(spark: SparkSession, sf: str) -> DataFrame:
    year = (_k() % 15 + 2010).cast("string")
    name = F.when(_k() % 5 == 0, _say("EEFF_31.03.", year, ".pdf")).when(_k() % 5 == 1, _say("Balance Junio ", year)).when(_k() % 5 == 2, _say("estados ", year, " 3T")).when(_k() % 5 == 3, _say("estados 31-12-", year, ".pdf")).otherwise(_say("memoria ", year))
    return _parts(spark, sf, name=name).select("k", S.file_period("name").alias("p")).select("k", "p.*")


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'http://b.org/x y' WHEN 1 THEN 'https://cdn.org/a' WHEN 2 THEN 'https://a.com/docs/' ELSE 'https://a.com/' END || p_partkey || '-' || (2000 + p_partkey % 30) || '.pdf' AS url,
CASE p_partkey % 4 WHEN 0 THEN 'x_y' WHEN 1 THEN 'a' ELSE '' END || p_partkey || '-' || (2000 + p_partkey % 30) || '.pdf' AS name, greatest(2000 + p_partkey % 30, CASE WHEN p_partkey >= 2000 AND p_partkey < 2100 THEN p_partkey END)::INTEGER AS score FROM part WHERE p_partkey < 2000 ORDER BY score DESC, k LIMIT 50""")
def op_f19_o5(spark: SparkSession, sf: str) -> DataFrame:
    url = _say(F.when(_k() % 4 == 0, "http://b.org/x y").when(_k() % 4 == 1, "//cdn.org/a").when(_k() % 4 == 2, "/docs/").otherwise(""), _k(), "-", _k() % 30 + 2000, ".pdf")
    rows = _parts(spark, sf, found=url).filter("k < 2000").withColumn("url", S.absolute_url("found", F.lit("https://a.com/investors/index.html")))
    return rows.select("k", "url", S.safe_name(S.base_name("url")).alias("name"), S.recency("url").alias("score")).orderBy(F.desc("score"), "k").limit(50)


@query("""SELECT p_partkey AS page, 'https://a.com/eeff_' || p_partkey || '.PDF' AS url, 0 AS level FROM part UNION SELECT p_partkey, 'https://a.com/eeff_' || (p_partkey + 1) || '.PDF', 1 FROM part WHERE p_partkey % 2 = 0 AND p_partkey + 1 IN (SELECT p_partkey FROM part)""")
def op_f20(spark: SparkSession, sf: str) -> DataFrame:
    """Statement files that a page links, and those of the pages one level below."""
    lower = F.when(_k() % 2 == 0, _say('<a href="/estados/', _k() + 1, '">Estados</a>')).otherwise("")
    html = _say("<a href='eeff_", _k(), ".PDF'>x</a><a href=\"other.pdf\">y</a><a href='/news/1'>n</a>", lower)
    pages = _parts(spark, sf, html=html).select("k", _say("https://a.com/estados/", _k()).alias("address"), F.explode(F.transform(S.links("html"), lambda x: S.absolute_url(x, F.lit("https://a.com/")))).alias("url"))
    files = pages.filter(S.is_statement(F.col("url")))
    below = pages.filter(S.leads_to_statements(F.col("url"))).select(F.col("k").alias("page"), F.col("url").alias("address")).join(files, "address").select("page", "url", F.lit(1).alias("level"))
    return files.select(F.col("k").alias("page"), "url", F.lit(0).alias("level")).unionByName(below).distinct()


_PAGE = """'<TABLE><tr class=a><th>x</th>' || repeat('<td>1</td>', CAST(p_partkey % 4 AS INTEGER)) || '</tr>' || repeat('<tr><td>y</td></tr>', CAST(p_partkey % 3 AS INTEGER)) || '</table><script src="a.js"></script><script>var total = 1; window.app.x; fetch(''/api/v' || p_partkey || '.json'')</script>'"""


@query("SELECT p_partkey AS k, 1::BIGINT AS tables, 1 + p_partkey % 3 AS rows, 1 + p_partkey % 4 AS first_row, 2::BIGINT AS scripts FROM part")
def op_f21(spark: SparkSession, sf: str) -> DataFrame:
    page = F.expr(_PAGE)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), page.alias("html")).select("k", *[c.alias(n) for n, c in S.page_structure("html").items()])


@query(f"""WITH p AS (SELECT p_partkey AS k FROM part) SELECT k, name, n::INTEGER AS n, first FROM p, LATERAL (VALUES ('path', 1, '/api/v' || k), ('fetch', 1, '''/api/v' || k || '.json'''), ('json', 1, '/api/v' || k || '.json'), ('script', 1, 'a.js'), ('window', 1, 'window.app.x'), ('variable', 1, 'total')) v(name, n, first)""")
def op_f22(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.expr(_PAGE).alias("html"))
    found = rows.select("k", F.explode(S.page_finds("html")).alias("f")).filter(F.size("f.found") > 0)
    return found.select("k", "f.name", F.size("f.found").alias("n"), F.element_at("f.found", 1).alias("first"))


@query("SELECT p_partkey AS k, 'café ' || chr(233) || ' – €' || p_partkey || ' &amp; ½ <b>' AS text FROM part")
def op_f7_references(spark: SparkSession, sf: str) -> DataFrame:
    page = _say("<p>caf&eacute;&nbsp;&#233; <b>&ndash; &#x20AC;", _k(), "</b>\n &amp;amp; &frac12; &lt;b></p>")
    return _parts(spark, sf, html=page).select("k", S.page_text("html").alias("text"))

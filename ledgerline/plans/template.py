"""Queries over a regulator's template, retries, documents in parts, and groups by tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import statements as S
from ledgerline.operators import joins, template
from ledgerline.plans.base import query
from ledgerline.plans.facts import WIDE_SQL, wide
from ledgerline.session import scratch, table
from ledgerline.sources import sinks
from ledgerline.streaming import incremental

_GIVEN = ("liquidez", "solvencia", "roe", "roa", "endeudamiento", "apalancamiento", "margen_neto", "deuda_fin_ebitda", "ebitda_costos_fin", "prueba_acida", "cobertura_intereses", "rotacion_activos")


@query(f"""WITH {WIDE_SQL}, given AS (SELECT entity, name AS ratio, n, CASE WHEN (entity + n) % 5 > 0 THEN (entity % 7 - 3 + n) / 4.0::DOUBLE END AS official FROM wide, (VALUES {", ".join(f"('{g}', {k})" for k, g in enumerate(_GIVEN))}) v(name, n)),
r AS (SELECT given.entity, ratio, official, CASE ratio WHEN 'liquidez' THEN round(cash, 2) / nullif(round(shares, 2), 0) WHEN 'roe' THEN round(net_income, 2) / nullif(round(equity, 2), 0) WHEN 'roa' THEN round(net_income, 2) / nullif(round(cfo, 2), 0)
    WHEN 'margen_neto' THEN round(net_income, 2) / nullif(round(revenue, 2), 0) WHEN 'deuda_fin_ebitda' THEN coalesce(round(debt, 2), 0) / nullif(round(operating_income, 2), 0) END AS ours FROM given JOIN wide USING (entity))
SELECT entity, ratio, official, round(ours, 6) AS ours, round((ours - official) / nullif(official, 0) * 100, 4) AS gap, abs((ours - official) / nullif(official, 0) * 100) <= 50 AS agrees FROM r""")
def op_r_official(spark: SparkSession, sf: str) -> DataFrame:
    """Each entity's template as text, with some of the official ratios; all twelve beside ours."""
    rows = wide(spark, sf)
    line = lambda code, x: F.when(x.isNotNull(), F.format_string(f"{code} RUBRO (TOTAL) %.2f ", x)).otherwise("")
    held = {"1122500": "cash", "1139999": "cash", "2339999": "shares", "1999999": "cfo", "2299999": "equity", "2312300": "debt", "3000100": "revenue", "3049999": "net_income", "8000004": "operating_income"}
    codes = {name: code for code, name in template.OFFICIAL.items()}
    e = F.col("entity")
    given = [line(codes[g], F.when((e + k) % 5 > 0, (e % 7 - 3 + k) / F.lit(4.0))) for k, g in enumerate(_GIVEN)]
    texts = rows.select("entity", F.concat(*[line(code, F.col(name)) for code, name in held.items()], *given).alias("text"))
    found = template.compared(texts.withColumn("amounts", S.code_amounts("text")), "entity", "amounts", 50.0)
    return found.select("entity", "ratio", "official", F.round("ours", 6).alias("ours"), F.round("gap", 4).alias("gap"), "agrees")


@query("""WITH l AS (SELECT s_nationkey AS job, s_suppkey AS item, unnest(range(1, 1 + CAST(s_suppkey % 4 AS BIGINT))) AS attempt FROM supplier WHERE s_suppkey % 4 > 0), e AS (SELECT *, (item + attempt) % 3 > 0 AS bad FROM l),
i AS (SELECT job, item, count(*) AS attempts, count(*) FILTER (NOT bad) AS good FROM e GROUP BY 1, 2), s AS (SELECT *, CASE WHEN good > 0 THEN 'ok' WHEN attempts >= 3 THEN 'failed' ELSE 'retry' END AS state FROM i)
SELECT job, item, attempts, state, CASE WHEN state = 'retry' THEN [1, 3, 9][attempts] END AS wait FROM s""")
def op_i4_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts of every item as log rows, and which of them are to be tried again and when."""
    path = scratch(spark)
    item = F.col("s_suppkey")
    tries = table(spark, sf, "supplier").filter(item % 4 > 0).select(F.col("s_nationkey").alias("job"), item.alias("item"), F.explode(F.sequence(F.lit(1), (item % 4).cast("int"))).alias("attempt"))
    for k in (1, 2, 3):
        sinks.append_log(tries.filter(F.col("attempt") == k).withColumn("error", F.when((F.col("item") + F.col("attempt")) % 3 > 0, "timeout")), path)
    return incremental.attempts(spark.read.parquet(path)).select("job", "item", "attempts", "state", "wait")


@query("WITH o AS (SELECT o_orderstatus AS s, o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS BIGINT) // 500 AS part FROM orders) SELECT s, CAST(part AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM o GROUP BY 1, 2")
def op_w8_parts(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as documents of 500 rows at most."""
    made = sinks.envelope_parts(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("s"), "o_orderkey"), "now", ["o_orderkey"], "s", 500)
    doc = F.from_json("document", "part int, count int, rows array<struct<o_orderkey: long>>")
    return made.select("s", doc.alias("d")).select("s", "d.part", F.col("d.count").alias("n"), F.col("d.rows")[0]["o_orderkey"].alias("first"), F.element_at("d.rows", -1)["o_orderkey"].alias("last"))


@query("""WITH t AS (SELECT o_custkey AS k, list(DISTINCT o_orderkey % 1000) AS tags FROM orders GROUP BY 1) SELECT k, CASE WHEN len(list_filter(tags, lambda x: x % 50 = 7)) > 0 THEN 'sp500' WHEN len(list_filter(tags, lambda x: x % 20 = 3)) > 0 THEN 'adr_arg' WHEN len(list_filter(tags, lambda x: x % 10 = 9)) > 0 THEN 'adr_bra' ELSE 'otro' END AS "group" FROM t""")
def op_p13_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's tags (of its orders) against the members of three groups, which share some."""
    tag = F.col("o_orderkey") % 1000
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set(tag).alias("tags"))
    known = table(spark, sf, "orders").select(tag.alias("tag")).distinct()
    rules = (("adr_bra", 10, 9), ("sp500", 50, 7), ("adr_arg", 20, 3))
    groups = F.filter(F.array(*[F.when(F.col("tag") % m == r, g) for g, m, r in rules]), lambda g: g.isNotNull())
    return joins.first_group(rows, "k", "tags", known.withColumn("group", F.explode(groups)), ["sp500", "adr_arg", "adr_bra"]).select("k", "group")

"""Queries whose figures say where they come from, and profiles of tables that batches add to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import lineage, periods, profile
from ledgerline.plans.base import query, rounded
from ledgerline.plans.facts import LATEST_SQL, TTM_SQL, facts
from ledgerline.plans.series import PRIORITY_SQL, TAGGED_SQL, priorities, tagged
from ledgerline.session import scratch, table

_TAIL = "dp AS (" + TTM_SQL.split("dp AS (", 1)[1]
for _old, _new in (
    ('"end" AS y_end, val AS y_val FROM', '"end" AS y_end, val AS y_val, seq AS y_seq FROM'),
    ('max("end") AS a_end', 'max("end") AS a_end, list_sort(list(seq)) AS a_rows'),
    ("p_end, p_val, dp.val AS r_val,", "p_end, p_val, dp.val AS r_val, p_seq, dp.seq AS r_seq,"),
    ("END AS strategy\n", "END AS strategy, CASE WHEN a_end IS NOT NULL THEN a_rows WHEN y_val + p_val - r_val IS NOT NULL THEN list_sort([y_seq, p_seq, r_seq]) WHEN y_end IS NOT NULL THEN [y_seq] END AS rows\n"),
):
    assert _old in _TAIL, _old
    _TAIL = _TAIL.replace(_old, _new)
_SOURCED = f"""{TAGGED_SQL}, {PRIORITY_SQL}, tags AS (SELECT entity, concept, tag, max("end") AS last, min(priority) AS priority FROM tagged JOIN prio USING (tag) GROUP BY 1, 2, 3),
best AS (SELECT entity, concept, tag FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY last DESC, priority) AS rn FROM tags) WHERE rn = 1),
named AS (SELECT t.*, concept FROM tagged t JOIN best USING (entity, tag)),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, start, "end" ORDER BY filed DESC, seq) AS rn FROM named) WHERE rn = 1), {_TAIL},
m AS (SELECT ttm.*, tag FROM ttm JOIN best USING (entity, concept))"""


@query(f"""WITH {_SOURCED}, r AS (SELECT coalesce(a.entity, b.entity) AS entity, 'a_to_b' AS ratio, CASE WHEN b.value > 0 THEN a.value / b.value END AS value FROM (SELECT * FROM m WHERE concept = 'A') a FULL JOIN (SELECT * FROM m WHERE concept = 'B') b ON a.entity = b.entity
UNION ALL SELECT coalesce(a.entity, b.entity), 'b_to_a', b.value / nullif(a.value, 0) FROM (SELECT * FROM m WHERE concept = 'A') a FULL JOIN (SELECT * FROM m WHERE concept = 'B') b ON a.entity = b.entity)
SELECT r.entity, ratio, round(r.value, 6) AS value, m.concept, round(m.value, 2) AS part, m."end", strategy, tag, rows FROM r JOIN m ON r.entity = m.entity""")
def op_lineage_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Two ratios of every entity with the figures, tags, strategies, ends and rows behind them."""
    metrics = lineage.sourced_metrics(tagged(spark, sf), priorities(spark))
    found = lineage.sourced_ratios(metrics, {"a_to_b": lineage.Formula("A", "B", True), "b_to_a": lineage.Formula("B", "A")})
    return found.select("entity", "ratio", F.round("value", 6).alias("value"), F.explode("parts").alias("p")).select("entity", "ratio", "value", "p.concept", F.round("p.value", 2).alias("part"), "p.end", "p.strategy", "p.tag", "p.rows")


_ANNUAL = LATEST_SQL + """, y AS (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC) AS k FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, "end" ORDER BY filed DESC, seq) AS rn FROM facts WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380) WHERE rn = 1),
g AS (SELECT entity, concept, max(CASE WHEN k = 1 THEN val END) AS last, max(CASE WHEN k = 1 THEN "end" END) AS last_end, max(CASE WHEN k = 4 THEN val END) AS base, max(CASE WHEN k = 4 THEN "end" END) AS base_end FROM y GROUP BY 1, 2)"""


@query(f"WITH {_ANNUAL} SELECT entity, concept, CASE WHEN last > 0 AND base > 0 THEN round(pow(last / base, 1.0 / 3) - 1, 6) END AS cagr, round(last, 6) AS last, last_end, round(base, 6) AS base, base_end FROM g")
def op_lineage_growth(spark: SparkSession, sf: str) -> DataFrame:
    """Growth over three years with the two figures and ends behind it."""
    return rounded(lineage.sourced_growth(periods.annual_series(facts(spark, sf)), 3))


@query(f"""WITH {LATEST_SQL}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC, seq) AS rn FROM latest WHERE kind = 1) WHERE rn = 1),
b AS (SELECT l.entity, l.concept, l.val AS current, l."end" AS current_end, o.val AS previous, o."end" AS previous_end, row_number() OVER (PARTITION BY l.entity, l.concept ORDER BY o."end" DESC NULLS LAST, o.seq) AS rn FROM l LEFT JOIN (SELECT * FROM latest WHERE kind = 1) o ON o.entity = l.entity AND o.concept = l.concept AND date_diff('day', o."end", l."end") BETWEEN 300 AND 430)
SELECT entity, concept, round(coalesce((current + previous) / 2, current), 4) AS average, round(current, 4) AS current, current_end, round(previous, 4) AS previous, previous_end FROM b WHERE rn = 1""")
def op_lineage_balance(spark: SparkSession, sf: str) -> DataFrame:
    """The mean balance with the two balances and ends behind it."""
    return rounded(lineage.sourced_balance(periods.latest_filed(facts(spark, sf)).filter("kind = 1")), 4)


_PROFILED = "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'nan'::DOUBLE ELSE o_totalprice END AS price, CAST(o_orderdate AS DATE) AS day FROM orders"


@query(f"""WITH t AS ({_PROFILED}), g AS (SELECT CASE WHEN NOT isnan(price) THEN price END AS price FROM t)
SELECT 'o_orderkey' AS column, 'bigint' AS type, count(*) AS n, count(*) - count(o_orderkey) AS missing, NULL::VARCHAR AS least, NULL::VARCHAR AS most, min(o_orderkey)::DOUBLE AS least_number, max(o_orderkey)::DOUBLE AS most_number, round(avg(o_orderkey), 4) AS mean FROM t
UNION ALL SELECT 'o_orderstatus', 'string', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus), NULL, NULL, NULL FROM t
UNION ALL SELECT 'price', 'double', count(*), count(*) - count(price), NULL, NULL, min(price), max(price), round(avg(price), 4) FROM g
UNION ALL SELECT 'day', 'date', count(*), count(*) - count(day), min(day)::VARCHAR, max(day)::VARCHAR, NULL, NULL, NULL FROM t""")
def op_a22_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of orders from three batches, one of which came twice."""
    path, key = scratch(spark), F.col("o_orderkey")
    price = F.when(key % 7 == 0, None).when(key % 11 == 0, F.lit("NaN").cast("double")).otherwise(F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", price.alias("price"), F.to_date("o_orderdate").alias("day"))
    for k in (0, 1, 2, 1):
        profile.add_batch(rows.filter(key % 3 == k), path, str(k))
    return profile.read(spark, path).select("column", "type", "n", "missing", "least", "most", "least_number", "most_number", F.round("mean", 4).alias("mean"))

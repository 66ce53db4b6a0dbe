"""Queries over metric resolution and annual series, on facts whose tags, units and taxonomies are made
from entity and concept by one rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import intervals, periods
from ledgerline.plans.base import query, rounded
from ledgerline.plans.facts import FACTS_SQL, facts

_PRIORITIES = [("1-URGENT", "A", 1), ("2-HIGH", "A", 2), ("3-MEDIUM", "A", 3), ("4-NOT SPECIFIED", "B", 1), ("5-LOW", "B", 2)]
PRIORITY_SQL = "prio(tag, concept, priority) AS (VALUES " + ", ".join(map(str, _PRIORITIES)) + ")"
# without the first tag for some entities, and without its newest years for others
TAGGED_SQL = FACTS_SQL + """, tagged AS (SELECT * EXCLUDE (concept), concept AS tag FROM facts WHERE NOT (concept LIKE '1%' AND entity % 3 = 0) AND NOT (concept LIKE '1%' AND entity % 2 = 0 AND "end" > DATE '1996-12-31'))"""


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    first, e = F.col("concept").startswith("1"), F.col("entity")
    rows = facts(spark, sf).filter(~(first & (e % 3 == 0)) & ~(first & (e % 2 == 0) & (F.col("end") > "1996-12-31")))
    return rows.withColumnRenamed("concept", "tag")


def priorities(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or _PRIORITIES, "tag string, concept string, priority int")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("entity", "concept", "tag").agg(F.count(F.lit(1)).alias("n"), F.max("end").alias("last"))


@query(f"""WITH {FACTS_SQL}, u AS (SELECT *, CASE WHEN kind = 1 THEN 'USD/shares' WHEN kind = 2 AND entity % 2 = 0 THEN 'shares' WHEN kind = 3 AND entity % 3 > 0 THEN 'USD' WHEN kind = 3 THEN 'pure' ELSE 'EUR' END AS unit FROM facts WHERE entity % 5 > 0 OR kind > 1),
k AS (SELECT *, CASE unit WHEN 'USD' THEN 1 WHEN 'USD/shares' THEN 2 WHEN 'shares' THEN 3 WHEN 'pure' THEN 4 END AS rank FROM u) SELECT entity, concept, unit, count(*) AS n FROM (SELECT *, min(rank) OVER (PARTITION BY entity, concept) AS best FROM k) WHERE rank = best GROUP BY ALL""")
def op_t3(spark: SparkSession, sf: str) -> DataFrame:
    kind, e = F.col("kind"), F.col("entity")
    unit = F.when(kind == 1, "USD/shares").when((kind == 2) & (e % 2 == 0), "shares").when((kind == 3) & (e % 3 > 0), "USD").when(kind == 3, "pure").otherwise("EUR")
    rows = facts(spark, sf).filter((e % 5 > 0) | (kind > 1)).withColumn("unit", unit)
    return periods.preferred_unit(rows).groupBy("entity", "concept", "unit").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {TAGGED_SQL}, {PRIORITY_SQL}, j AS (SELECT t.*, concept, priority, min(priority) OVER (PARTITION BY entity, concept) AS best FROM tagged t JOIN prio USING (tag)) SELECT entity, concept, tag, count(*) AS n, max("end") AS last FROM j WHERE priority = best GROUP BY ALL""")
def op_t4(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(periods.resolve_first(tagged(spark, sf), priorities(spark)))


@query(f"""WITH {TAGGED_SQL}, {PRIORITY_SQL}, m AS (SELECT entity, concept, tag, max("end") AS last, min(priority) AS priority, count(*) AS n FROM tagged JOIN prio USING (tag) GROUP BY ALL) SELECT entity, concept, tag, n, last FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY last DESC, priority) AS rn FROM m) WHERE rn = 1""")
def op_t5(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(periods.resolve_recent(tagged(spark, sf), priorities(spark)))


@query(f"""WITH {TAGGED_SQL}, c AS (SELECT *, CASE WHEN tag < '4' THEN 'A' ELSE 'B' END AS concept FROM tagged), m AS (SELECT entity, concept, tag, max("end") AS last, count(*) AS n, CASE tag WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 99 END AS priority FROM c WHERE NOT (tag = '3-MEDIUM' AND entity % 4 > 0) GROUP BY ALL)
SELECT entity, concept, tag, n, last FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY priority, tag) AS rn FROM m) WHERE rn = 1""")
def op_t6(spark: SparkSession, sf: str) -> DataFrame:
    rows = tagged(spark, sf).filter(~((F.col("tag") == "3-MEDIUM") & (F.col("entity") % 4 > 0)))
    rows = rows.withColumn("concept", F.when(F.col("tag") < "4", "A").otherwise("B"))
    return _counted(periods.resolve_priority(rows, priorities(spark, [("3-MEDIUM", "A", 1), ("1-URGENT", "A", 2)])))


@query(f"""WITH {FACTS_SQL}, t AS (SELECT *, CASE WHEN concept < '2' OR (concept < '3' AND entity % 2 = 0) OR (concept < '4' AND entity % 4 = 0 AND kind > 1) THEN 'ifrs-full' ELSE 'us-gaap' END AS taxonomy FROM facts WHERE entity % 6 > 0 OR concept < '4'),
n AS (SELECT entity, count(DISTINCT CASE WHEN taxonomy = 'ifrs-full' THEN concept END) AS i, count(DISTINCT CASE WHEN taxonomy = 'us-gaap' THEN concept END) AS g FROM t GROUP BY 1)
SELECT t.entity, taxonomy, count(*) AS n FROM t JOIN n ON t.entity = n.entity AND taxonomy = CASE WHEN i > g THEN 'ifrs-full' ELSE 'us-gaap' END GROUP BY ALL""")
def op_a15(spark: SparkSession, sf: str) -> DataFrame:
    c, e = F.col("concept"), F.col("entity")
    ifrs = (c < "2") | ((c < "3") & (e % 2 == 0)) | ((c < "4") & (e % 4 == 0) & (F.col("kind") > 1))
    rows = facts(spark, sf).filter((e % 6 > 0) | (c < "4")).withColumn("taxonomy", F.when(ifrs, "ifrs-full").otherwise("us-gaap"))
    return periods.elect_scheme(rows).groupBy("entity", "taxonomy").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {FACTS_SQL}, given AS (SELECT *, CASE WHEN fy % 3 > 0 THEN val END AS v FROM facts WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380) SELECT entity, concept, "end", v AS val FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, "end" ORDER BY filed DESC, seq) AS rn FROM given WHERE v IS NOT NULL) WHERE rn = 1""")
def op_t14(spark: SparkSession, sf: str) -> DataFrame:
    rows = facts(spark, sf).withColumn("val", F.when(F.col("fy") % 3 > 0, F.col("val")))
    return periods.clean_annual(rows).select("entity", "concept", "end", "val")


# balances: rows without a start, also of quarterly forms
_BALANCES = FACTS_SQL + """, mixed AS (SELECT entity, concept, start, "end", val, fy, form, filed, seq FROM facts WHERE fy % 2 = 0 UNION ALL SELECT entity, concept, NULL, "end", val * 2, fy, CASE WHEN kind = 3 THEN '10-K' ELSE '10-Q' END, filed, seq + 1000 FROM facts)"""


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["entity", "concept", "start", "end", "val", "fy", "form", "filed", "seq"]
    flows = facts(spark, sf)
    instants = flows.withColumns({"start": F.lit(None).cast("date"), "val": F.col("val") * 2, "seq": F.col("seq") + 1000})
    return flows.filter("fy % 2 = 0").select(*cols).unionByName(instants.select(*cols))


@query(f"""WITH {_BALANCES} SELECT entity, concept, "end", fy, val FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, "end" ORDER BY filed DESC, seq) AS rn FROM mixed WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380 OR (start IS NULL AND form = '10-K')) WHERE rn = 1""")
def op_t11_instants(spark: SparkSession, sf: str) -> DataFrame:
    return periods.annual_series(_balances(spark, sf)).select("entity", "concept", "end", "fy", "val")


@query(f"""WITH {_BALANCES} SELECT entity, concept, "end", fy, val FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, fy ORDER BY filed DESC, seq) AS rn FROM mixed WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380) WHERE rn = 1""")
def op_t13_instants(spark: SparkSession, sf: str) -> DataFrame:
    return periods.annual_series(_balances(spark, sf), by="fy", instants=False).select("entity", "concept", "end", "fy", "val")


@query(f"""WITH {FACTS_SQL}, annual AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, "end" ORDER BY filed DESC, seq) AS rn FROM facts WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380) WHERE rn = 1),
roe AS (SELECT i.entity, i."end", i.val / nullif(e.val, 0) AS val FROM annual i JOIN annual e ON i.entity = e.entity AND i."end" = e."end" AND i.concept LIKE '1%' AND e.concept LIKE '2%'),
k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY "end" DESC) AS k FROM roe), b AS (SELECT entity, max(CASE WHEN k = 1 THEN val END) AS last, max(CASE WHEN k = 6 THEN val END) AS base FROM k GROUP BY 1)
SELECT entity, CASE WHEN last > 0 AND base > 0 THEN round(pow(last / base, 0.2) - 1, 6) END AS roe_cagr FROM b""")
def op_t17(spark: SparkSession, sf: str) -> DataFrame:
    annual = periods.annual_series(facts(spark, sf))
    side = lambda digit, name: annual.filter(F.col("concept").startswith(digit)).select("entity", "end", F.col("val").alias(name))
    roe = side("1", "income").join(side("2", "equity"), ["entity", "end"]).select("entity", F.lit("roe").alias("concept"), "end", C.safe_ratio("income", "equity").alias("val"))
    return rounded(periods.cagr(roe).select("entity", F.col("cagr").alias("roe_cagr")))


@query(f"""WITH {FACTS_SQL}, annual AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, "end" ORDER BY filed DESC, seq) AS rn FROM facts WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380 AND val IS NOT NULL) WHERE rn = 1)
SELECT entity, concept, max("end") AS "end", round(arg_max(val, "end"), 4) AS eps_annual FROM annual GROUP BY 1, 2""")
def op_r_eps_annual(spark: SparkSession, sf: str) -> DataFrame:
    """The last clean annual figure, with the end that it comes from."""
    last = periods.last_value(periods.clean_annual(facts(spark, sf)))
    return rounded(last.select("entity", "concept", "end", F.col("val").alias("eps_annual")), 4)


@query(f"""WITH {FACTS_SQL}, d AS (SELECT *, date_diff('day', start, "end") + 1 AS d FROM facts WHERE kind = 2), y AS (SELECT entity, concept, max("end") AS y_end FROM facts WHERE kind = 3 AND "end" < DATE '1998-01-01' GROUP BY 1, 2),
newest AS (SELECT * FROM (SELECT d.*, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC, seq) AS rn FROM d JOIN y USING (entity, concept) WHERE abs(date_diff('day', y_end, start)) <= 7) WHERE rn = 1)
SELECT p.entity, p.concept, p.seq, min(o.seq) AS prior_seq FROM newest p LEFT JOIN d o ON o.entity = p.entity AND o.concept = p.concept AND date_diff('day', o."end", p."end") BETWEEN 350 AND 380 AND abs(o.d - p.d) <= 7 GROUP BY 1, 2, 3""")
def op_j12(spark: SparkSession, sf: str) -> DataFrame:
    """The newest part right behind the last year before 1998, with the same part a year earlier."""
    rows = facts(spark, sf)
    year = rows.filter((F.col("kind") == 3) & (F.col("end") < "1998-01-01")).groupBy("entity", "concept").agg(F.max("end").alias("y_end"))
    parts = rows.filter("kind = 2")
    near = parts.join(year, ["entity", "concept"]).filter(F.abs(F.datediff("start", "y_end")) <= 7)
    newest = near.groupBy("entity", "concept").agg(F.max_by("seq", F.struct(F.col("end"), -F.col("seq"))).alias("seq"))
    priors = intervals.year_earlier_pairs(parts).groupBy("entity", "concept", "seq").agg(F.min("prior_seq").alias("prior_seq"))
    return newest.join(priors, ["entity", "concept", "seq"], "left")

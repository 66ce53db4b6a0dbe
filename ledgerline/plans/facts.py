"""Facts derived from the test tables: orders by nation and priority as quarterly, year-to-date
and yearly periods, with late corrections; and one wide row of balance items for each nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.session import table

FACTS_SQL = """
q AS (SELECT c_nationkey AS entity, o_orderpriority AS concept, year(o_orderdate) AS y, quarter(o_orderdate) AS k,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4),
ytd AS (SELECT entity, concept, y, k, v, sum(v) OVER (PARTITION BY entity, concept, y ORDER BY k) AS run,
               count(*) OVER (PARTITION BY entity, concept, y) AS quarters FROM q),
p AS (SELECT entity, concept, y, k, make_date(CAST(y AS BIGINT), CAST(3*k-2 AS BIGINT), 1) AS start, v AS val, 1 AS kind FROM ytd WHERE NOT (entity % 3 = 0 AND k = 4)
      UNION ALL SELECT entity, concept, y, k, make_date(CAST(y AS BIGINT), 1, 1), run, 2 FROM ytd WHERE k IN (2, 3)
      UNION ALL SELECT entity, concept, y, k, make_date(CAST(y AS BIGINT), 1, 1), run, 3 FROM ytd WHERE k = 4),
e AS (SELECT entity, concept, y, kind, start, last_day(make_date(CAST(y AS BIGINT), CAST(3*k AS BIGINT), 1)) AS "end", val FROM p),
f AS (SELECT *, 0 AS late FROM e UNION ALL SELECT entity, concept, y, kind, start, "end", val + 1, 1 FROM e WHERE entity % 2 = 0 AND kind = 3),
facts AS (SELECT entity, concept, kind, start, "end", CAST(val AS DOUBLE) AS val, y AS fy, CASE WHEN kind = 3 THEN '10-K' ELSE '10-Q' END AS form,
                 CAST("end" + CAST(40 + 300 * late AS INTEGER) AS DATE) AS filed,
                 row_number() OVER (PARTITION BY entity, concept ORDER BY "end", start, late) AS seq FROM f)
"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    q = joined.groupBy(F.col("c_nationkey").alias("entity"), F.col("o_orderpriority").alias("concept"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("k")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    year = W.partitionBy("entity", "concept", "y").orderBy("k")
    ytd = q.withColumn("run", F.sum("v").over(year))
    day = lambda m: F.make_date("y", m, F.lit(1))
    kinds = F.array(
        F.when(~((F.col("entity") % 3 == 0) & (F.col("k") == 4)), F.struct(day(3 * F.col("k") - 2).alias("start"), F.col("v").alias("val"), F.lit(1).alias("kind"))),
        F.when(F.col("k").isin(2, 3), F.struct(day(F.lit(1)).alias("start"), F.col("run").alias("val"), F.lit(2).alias("kind"))),
        F.when(F.col("k") == 4, F.struct(day(F.lit(1)).alias("start"), F.col("run").alias("val"), F.lit(3).alias("kind"))),
    )
    periods = ytd.select("entity", "concept", "y", F.last_day(day(3 * F.col("k"))).alias("end"), F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("p")).select("entity", "concept", "y", "end", "p.*")
    late = F.when((F.col("entity") % 2 == 0) & (F.col("kind") == 3), F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = periods.withColumn("late", F.explode(late))
    order = W.partitionBy("entity", "concept").orderBy("end", "start", "late")
    return rows.select("entity", "concept", "kind", "start", "end", (F.col("val") + F.col("late")).cast("double").alias("val"), F.col("y").alias("fy"), F.when(F.col("kind") == 3, "10-K").otherwise("10-Q").alias("form"), F.date_add("end", 40 + 300 * F.col("late")).alias("filed"), F.row_number().over(order).alias("seq"))


WIDE_SQL = """
o AS (SELECT c_nationkey AS entity, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue,
             sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS gross_profit,
             sum(CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS operating_income,
             sum(CASE WHEN o_orderpriority LIKE '2%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS net_income,
             sum(CASE WHEN o_orderpriority LIKE '3%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS depreciation,
             sum(CASE WHEN o_orderpriority LIKE '4%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS cfo,
             sum(CASE WHEN o_orderpriority LIKE '5%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS capex
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
b AS (SELECT c_nationkey AS entity, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS equity,
             sum(CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS debt,
             sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS cash,
             count(*) AS shares FROM customer GROUP BY 1),
wide AS (SELECT b.entity, CAST(revenue AS DOUBLE) AS revenue, CAST(gross_profit AS DOUBLE) AS gross_profit, CAST(operating_income AS DOUBLE) AS operating_income,
             CAST(net_income AS DOUBLE) AS net_income, CAST(depreciation AS DOUBLE) AS depreciation, CAST(cfo AS DOUBLE) AS cfo, CAST(capex AS DOUBLE) AS capex,
             CAST(equity AS DOUBLE) AS equity, CAST(debt AS DOUBLE) AS debt, CAST(cash AS DOUBLE) AS cash, CAST(shares AS DOUBLE) AS shares FROM b LEFT JOIN o USING (entity))
"""


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    price, balance = F.col("o_totalprice").cast("decimal(18,2)"), F.col("c_acctbal").cast("decimal(18,2)")
    part = lambda digit: F.sum(F.when(F.col("o_orderpriority").startswith(digit), price)).cast("double")
    o = orders.join(customers, orders.o_custkey == customers.c_custkey).groupBy(F.col("c_nationkey").alias("entity")).agg(F.sum(price).cast("double").alias("revenue"), F.sum(F.when(F.col("o_orderstatus") == "F", price)).cast("double").alias("gross_profit"), *[part(str(k)).alias(n) for k, n in enumerate(("operating_income", "net_income", "depreciation", "cfo", "capex"), 1)])
    held = lambda segment: F.sum(F.when(F.col("c_mktsegment") == segment, balance)).cast("double")
    b = customers.groupBy(F.col("c_nationkey").alias("entity")).agg(F.sum(balance).cast("double").alias("equity"), held("BUILDING").alias("debt"), held("MACHINERY").alias("cash"), F.count(F.lit(1)).cast("double").alias("shares"))
    return b.join(o, "entity", "left")


# SQL of the latest filed rows and of the trailing twelve months
LATEST_SQL = FACTS_SQL + """, latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, start, "end" ORDER BY filed DESC, seq) AS rn FROM facts) WHERE rn = 1)"""
TTM_SQL = LATEST_SQL + """,
dp AS (SELECT *, date_diff('day', start, "end") + 1 AS d FROM latest),
qs AS (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC, seq) AS rn FROM dp WHERE d BETWEEN 85 AND 100),
qg AS (SELECT *, abs(date_diff('day', lag("end") OVER (PARTITION BY entity, concept ORDER BY "end", rn DESC), start)) AS off FROM qs WHERE rn <= 4),
a AS (SELECT entity, concept, sum(val) AS a_value, max("end") AS a_end FROM qg GROUP BY 1, 2 HAVING count(*) = 4 AND coalesce(max(off), 0) <= 5),
yr AS (SELECT entity, concept, "end" AS y_end, val AS y_val FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC, seq) AS rn FROM dp WHERE d BETWEEN 355 AND 380) WHERE rn = 1),
pt AS (SELECT * FROM (SELECT dp.entity, dp.concept, dp.seq AS p_seq, dp."end" AS p_end, dp.d AS p_d, dp.val AS p_val, row_number() OVER (PARTITION BY dp.entity, dp.concept ORDER BY dp."end" DESC, dp.seq) AS rn
       FROM dp JOIN yr USING (entity, concept) WHERE dp.d <= 300 AND abs(date_diff('day', y_end, start)) <= 7) WHERE rn = 1),
pr AS (SELECT * FROM (SELECT dp.entity, dp.concept, p_end, p_val, dp.val AS r_val, row_number() OVER (PARTITION BY dp.entity, dp.concept ORDER BY dp.seq) AS rn
       FROM dp JOIN pt USING (entity, concept) WHERE dp.seq <> p_seq AND date_diff('day', dp."end", p_end) BETWEEN 350 AND 380 AND abs(dp.d - p_d) <= 7) WHERE rn = 1),
ttm AS (SELECT k.entity, k.concept, coalesce(a_value, y_val + p_val - r_val, y_val) AS value,
        CASE WHEN a_end IS NOT NULL THEN a_end WHEN r_val IS NOT NULL THEN p_end ELSE y_end END AS "end",
        CASE WHEN a_end IS NOT NULL THEN 'A' WHEN y_val + p_val - r_val IS NOT NULL THEN 'B' WHEN y_end IS NOT NULL THEN 'C' END AS strategy
        FROM (SELECT DISTINCT entity, concept FROM dp) k LEFT JOIN a USING (entity, concept) LEFT JOIN yr USING (entity, concept) LEFT JOIN pr USING (entity, concept))"""

"""Queries over whole histories: periods near each other, what was known when, trailing months at every period end,
tables and views that batches keep up to date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import intervals, periods
from ledgerline.plans.base import query, rounded
from ledgerline.plans.facts import FACTS_SQL, LATEST_SQL, TTM_SQL, facts
from ledgerline.session import scratch, table
from ledgerline.sources.buckets import BucketTable
from ledgerline.streaming.maintenance import Jobs

_LENGTH = "date_diff('day', start, \"end\") + 1"


@query(f"""WITH {LATEST_SQL}, b AS (SELECT * FROM latest WHERE kind = 1),
r AS (SELECT b.*, o.val AS prior, o."end" AS prior_end, row_number() OVER (PARTITION BY b.entity, b.concept, b.seq ORDER BY o."end" DESC NULLS LAST, o.seq) AS rn
      FROM b LEFT JOIN b o ON o.entity = b.entity AND o.concept = b.concept AND date_diff('day', o."end", b."end") BETWEEN 300 AND 430)
SELECT entity, concept, "end", val, prior, prior_end FROM r WHERE rn = 1""")
def op_j11_every_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Every quarter-end balance with the latest one 300 to 430 days older."""
    found = intervals.earlier_balances(periods.latest_filed(facts(spark, sf)).filter("kind = 1"))
    return found.select("entity", "concept", "end", "val", "prior", "prior_end")


@query(f"""WITH {LATEST_SQL}, y AS (SELECT * FROM latest WHERE {_LENGTH} BETWEEN 355 AND 380), parts AS (SELECT * FROM latest WHERE {_LENGTH} <= 300),
r AS (SELECT y.entity, y.concept, y.seq AS year_seq, y."end" AS year_end, p.seq AS part_seq, p."end" AS part_end, row_number() OVER (PARTITION BY y.entity, y.concept, y.seq ORDER BY p."end" DESC NULLS LAST, p.seq) AS rn
      FROM y LEFT JOIN parts p ON p.entity = y.entity AND p.concept = y.concept AND date_diff('day', y."end", p.start) BETWEEN -7 AND 7)
SELECT entity, concept, year_seq, year_end, part_seq, part_end FROM r WHERE rn = 1""")
def op_j12_every_year(spark: SparkSession, sf: str) -> DataFrame:
    """Every year with the newest part that starts within a week of its end."""
    return intervals.following_parts(periods.latest_filed(facts(spark, sf)))


_KEY = ["entity", "concept", "kind", "end"]
#: Quarter days from 1993 to 1999.
_DATES = [dt.date(y, m, 1) for y in range(1993, 2000) for m in (1, 4, 7, 10)]


@query(f"""WITH {FACTS_SQL}, d AS (SELECT CAST(unnest(generate_series(DATE '1993-01-01', DATE '1999-10-01', INTERVAL 3 MONTH)) AS DATE) AS as_of),
r AS (SELECT f.*, as_of, row_number() OVER (PARTITION BY entity, concept, kind, "end", as_of ORDER BY filed DESC, seq DESC) AS rn FROM facts f JOIN d ON filed <= as_of)
SELECT entity, concept, kind, "end", as_of, filed, val FROM r WHERE rn = 1""")
def op_t26_many_dates(spark: SparkSession, sf: str) -> DataFrame:
    """What was known of every period at each quarter day of seven years."""
    return intervals.known_at_dates(facts(spark, sf), _KEY, _DATES, "filed").select(*_KEY, "as_of", "filed", "val")


@query(f"""WITH {FACTS_SQL}, w AS (SELECT DISTINCT entity, concept, kind, "end", CAST("end" + CAST(30 * (entity % 13) AS INTEGER) AS DATE) AS asked FROM facts),
r AS (SELECT w.*, f.filed, f.val, row_number() OVER (PARTITION BY w.entity, w.concept, w.kind, w."end" ORDER BY f.filed DESC NULLS LAST, f.seq DESC) AS rn
      FROM w LEFT JOIN facts f ON f.entity = w.entity AND f.concept = w.concept AND f.kind = w.kind AND f."end" = w."end" AND filed <= asked)
SELECT entity, concept, kind, "end", asked, filed, val FROM r WHERE rn = 1""")
def op_t26_as_of_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every period asked for at a date of its own, up to a year after its end."""
    rows = facts(spark, sf)
    wanted = rows.select(*_KEY, F.date_add("end", 30 * (F.col("entity") % 13).cast("int")).alias("asked")).distinct()
    return intervals.as_of_join(wanted, rows, _KEY, "asked", "filed").select(*_KEY, "asked", "filed", "val")


_HEAD, _TAIL = TTM_SQL.split("dp AS (", 1)
_ROWS, _TAIL = _TAIL.split("),\n", 1)
_TAIL = _TAIL.replace("dp.entity, dp.concept", "dp.entity, dp.concept, dp.at_").replace("entity, concept", "entity, concept, at_").replace("k.entity, k.concept", "k.entity, k.concept, k.at_").replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3")
_ROLLING = _HEAD + f"""ends AS (SELECT DISTINCT entity, concept, "end" AS at_ FROM latest),
dp AS (SELECT l.*, at_, {_LENGTH} AS d FROM latest l JOIN ends e ON l.entity = e.entity AND l.concept = e.concept AND l."end" <= at_),
""" + _TAIL


@query(f'WITH {_ROLLING} SELECT entity, concept, at_ AS as_of, round(value, 2) AS value, "end", strategy FROM ttm')
def op_t8_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """The trailing twelve months as every period end saw them."""
    return rounded(intervals.rolling_twelve_months(periods.latest_filed(facts(spark, sf))), 2)


_THIRDS = ("filed < '1997-06-30'", "filed >= '1997-06-30' and filed < '1999-12-31'", "filed >= '1999-12-31'")


@query(f"""WITH {TTM_SQL}, last AS (SELECT c_nationkey AS entity, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS price FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
quote AS (SELECT entity, arg_max(price, day) AS price FROM last GROUP BY 1)
SELECT entity, concept, round(value, 2) AS value, "end", strategy, price, CASE WHEN value > 0 THEN round(price / value, 6) END AS multiple FROM ttm LEFT JOIN quote USING (entity)""")
def op_i2_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of filings and two of quotes, in between the view is brought up to date; at last the view."""
    jobs = Jobs(spark, scratch(spark), buckets=16)
    rows = facts(spark, sf)
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    quotes = orders.join(customers, orders.o_custkey == customers.c_custkey).select(F.col("c_nationkey").alias("entity"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"))
    jobs.load_financials(rows.filter(_THIRDS[0]))
    jobs.load_quotes(quotes.filter("day < '1998-01-01'"))
    jobs.refresh()
    jobs.load_financials(rows.filter(_THIRDS[2]))
    jobs.load_quotes(quotes.filter("day >= '1998-01-01'"))
    jobs.load_financials(rows.filter(_THIRDS[1]))
    jobs.refresh()
    found = jobs.view.read(spark).select("entity", "concept", "value", "end", "strategy", "price", "multiple")
    return found.withColumns({"value": F.round("value", 2), "multiple": F.round("multiple", 6)})


_NEWEST = "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"


@query(_NEWEST)
def op_w1_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The later events first, then the earlier ones, which may not replace what is newer."""
    held = BucketTable(scratch(spark), ("user_id", "event_type"), 16)
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    for k in (1, 0, 1):
        held.upsert(events.filter(F.col("event_id") % 2 == k), ["user_id", "event_type"], ["ts", "event_id"])
    return held.read(spark).select("user_id", "event_type", "event_id", "value")


@query("SELECT o_custkey, o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price FROM orders WHERE o_custkey % 3 > 0 OR o_orderstatus = 'F' OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def op_w4_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Every third customer is reloaded with finished orders at twice the price, as far as there are any."""
    held = BucketTable(scratch(spark), ("o_custkey",), 16)
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    held.replace_groups(orders, "o_custkey")
    held.replace_groups(orders.filter("o_custkey % 3 = 0 and o_orderstatus = 'F'").withColumn("price", F.col("price") * 2), "o_custkey")
    return held.read(spark).select("o_custkey", "o_orderkey", "price")

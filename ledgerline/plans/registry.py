"""Every query of the library by name, with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions import columns as C
from ledgerline.operators import intervals, joins, periods, ratios, screen, stats
from ledgerline.plans import history, labels, pages, series, sourced, storage, template, text  # noqa: F401  (they register their queries)
from ledgerline.plans.base import QUERIES, SQL, Query, query
from ledgerline.plans.base import r as _r
from ledgerline.plans.base import rounded as _rounded
from ledgerline.plans.facts import FACTS_SQL, LATEST_SQL, TTM_SQL, WIDE_SQL, facts, wide
from ledgerline.session import table
from ledgerline.sources import sinks
from ledgerline.streaming import incremental

def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


_LATEST, _TTM = LATEST_SQL, TTM_SQL


@query(f"WITH {_LATEST} SELECT entity, concept, kind, start, \"end\", val, filed FROM latest")
def op_t2(spark: SparkSession, sf: str) -> DataFrame:
    return periods.latest_filed(facts(spark, sf)).select("entity", "concept", "kind", "start", "end", "val", "filed")


@query(f"WITH {_TTM} SELECT entity, concept, round(value, 2) AS value, \"end\", strategy FROM ttm")
def op_t8(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(periods.trailing_twelve_months(periods.latest_filed(facts(spark, sf))), 2)


_TTM_OLD = _TTM
for _new, _old in (("dp.d <= 300", "dp.d BETWEEN 170 AND 290"), ("y_end, start)) <= 7", "y_end, start)) <= 5"), ("BETWEEN 350 AND 380 AND abs(dp.d - p_d) <= 7", "BETWEEN 355 AND 380 AND abs(dp.d - p_d) <= 5"), ("ORDER BY dp.seq) AS rn", 'ORDER BY dp."end" DESC, dp.seq) AS rn')):
    assert _new in _TTM_OLD, _new
    _TTM_OLD = _TTM_OLD.replace(_new, _old)


@query(f"WITH {_TTM_OLD} SELECT entity, concept, round(value, 2) AS value, \"end\", strategy FROM ttm")
def op_t9(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(periods.trailing_twelve_months(periods.latest_filed(facts(spark, sf)), periods.TTM_OLD), 2)


@query(f"WITH {FACTS_SQL} SELECT entity, concept, kind, date_diff('day', start, \"end\") + 1 AS days, CASE WHEN date_diff('day', start, \"end\") + 1 <= 120 THEN 'quarter' WHEN date_diff('day', start, \"end\") + 1 <= 210 THEN 'half' WHEN date_diff('day', start, \"end\") + 1 <= 300 THEN 'nine_months' ELSE 'annual' END AS period, count(*) AS n FROM facts GROUP BY ALL")
def op_t1_p12(spark: SparkSession, sf: str) -> DataFrame:
    days = C.inclusive_days("start", "end")
    return facts(spark, sf).withColumns({"days": days, "period": C.period_class(days)}).groupBy("entity", "concept", "kind", "days", "period").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {FACTS_SQL} SELECT entity, concept, arg_max(val, seq) AS val, max(\"end\") AS \"end\" FROM (SELECT *, rank() OVER (PARTITION BY entity, concept ORDER BY \"end\" DESC, seq) AS rk FROM facts) WHERE rk = 1 GROUP BY 1, 2")
def op_t10(spark: SparkSession, sf: str) -> DataFrame:
    return periods.last_value(facts(spark, sf))


_ANNUAL = FACTS_SQL + """, annual AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, "end" ORDER BY filed DESC, seq) AS rn FROM facts WHERE date_diff('day', start, "end") + 1 BETWEEN 355 AND 380) WHERE rn = 1),
ar AS (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC) AS k, row_number() OVER (PARTITION BY entity, concept ORDER BY val) AS up, count(*) OVER (PARTITION BY entity, concept) AS n FROM annual),
base AS (SELECT entity, concept, max(CASE WHEN k = 1 THEN val END) AS last, max(CASE WHEN k = 6 THEN val END) AS base, max(CASE WHEN up = n // 2 + 1 THEN val END) AS median FROM ar GROUP BY 1, 2)"""


@query(f"WITH {_ANNUAL} SELECT entity, concept, \"end\", fy, val FROM annual")
def op_t11(spark: SparkSession, sf: str) -> DataFrame:
    return periods.annual_series(facts(spark, sf)).select("entity", "concept", "end", "fy", "val")


@query(f"WITH {FACTS_SQL} SELECT entity, concept, \"end\", fy, val FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, fy ORDER BY filed DESC, seq) AS rn FROM facts WHERE date_diff('day', start, \"end\") + 1 BETWEEN 355 AND 380) WHERE rn = 1")
def op_t12(spark: SparkSession, sf: str) -> DataFrame:
    return periods.annual_series(facts(spark, sf), by="fy", instants=False).select("entity", "concept", "end", "fy", "val")


@query(f"WITH {_ANNUAL} SELECT entity, concept, CASE WHEN last > 0 AND base > 0 THEN round(pow(last / base, 1.0 / 5) - 1, 6) END AS cagr FROM base")
def op_t15(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(periods.cagr(periods.annual_series(facts(spark, sf))))


@query(f"WITH {_ANNUAL} SELECT entity, concept, CASE WHEN last > 0 AND base > 0 AND base >= 0.1 * median THEN round(pow(last / base, 1.0 / 5) - 1, 6) END AS cagr FROM base")
def op_t16_a17(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(periods.cagr(periods.annual_series(facts(spark, sf)), robust=True))


@query(f"""WITH {_LATEST}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY "end" DESC, seq) AS rn FROM latest WHERE kind = 1) WHERE rn = 1),
r AS (SELECT l.entity, l.concept, l.val, l."end", o.val AS prior, row_number() OVER (PARTITION BY l.entity, l.concept ORDER BY o."end" DESC NULLS LAST, o.seq) AS rn FROM l LEFT JOIN (SELECT * FROM latest WHERE kind = 1) o ON o.entity = l.entity AND o.concept = l.concept AND date_diff('day', o."end", l."end") BETWEEN 300 AND 430)
SELECT entity, concept, val, "end", prior, round(coalesce((val + prior) / 2, val), 4) AS average FROM r WHERE rn = 1""")
def op_t18_j11(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(periods.average_balance(periods.latest_filed(facts(spark, sf)).filter("kind = 1")), 4)


@query(f"WITH {_TTM} SELECT entity, concept, strategy, date_diff('day', \"end\", DATE '2003-06-01') / 365.25 > 2 AS stale, CASE WHEN NOT (date_diff('day', \"end\", DATE '2003-06-01') / 365.25 > 2) THEN round(value, 2) END AS value FROM ttm")
def op_t19(spark: SparkSession, sf: str) -> DataFrame:
    ttm = periods.trailing_twelve_months(periods.latest_filed(facts(spark, sf)))
    old = periods.stale(F.col("end"), "2003-06-01")
    return ttm.select("entity", "concept", "strategy", old.alias("stale"), F.when(~old, _r("value", 2)).alias("value"))


@query("""WITH t AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS d, o_totalprice AS p, o_orderkey FROM orders), l AS (SELECT entity, max(d) AS last FROM t GROUP BY 1)
SELECT entity, round(arg_max(p, (d, o_orderkey)) / max(p) - 1, 6) AS from_high, round(arg_max(p, (d, o_orderkey)) / min(p) - 1, 6) AS from_low FROM t JOIN l USING (entity) WHERE d > last - 365 GROUP BY entity""")
def op_t21(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("p"), "o_orderkey")
    last = t.groupBy("entity").agg(F.max("d").alias("last"))
    year = t.join(last, "entity").filter(F.col("d") > F.date_sub("last", 365))
    price = F.max_by("p", F.struct("d", "o_orderkey"))
    return year.groupBy("entity").agg(_r(price / F.max("p") - 1).alias("from_high"), _r(price / F.min("p") - 1).alias("from_low"))


@query(f"WITH {FACTS_SQL} SELECT entity, concept, count(*) AS n FROM facts WHERE \"end\" >= DATE '2001-09-30' - 1000 OR \"end\" IS NULL GROUP BY 1, 2")
def op_t22(spark: SparkSession, sf: str) -> DataFrame:
    return periods.within_history(facts(spark, sf), "2001-09-30", 1000).groupBy("entity", "concept").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT last_day(make_date(CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), 1)) AS month_end, CAST(last_day(make_date(CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), 1)) - 364 AS DATE) AS start, CAST(((month(o_orderdate) - 3 * (4 - quarter(o_orderdate)) - 1) % 12 + 12) % 12 + 1 AS INTEGER) AS fiscal_month FROM orders")
def op_t23_t24_t25(spark: SparkSession, sf: str) -> DataFrame:
    end = C.month_end(F.year("o_orderdate"), F.month("o_orderdate"))
    return table(spark, sf, "orders").select(end.alias("month_end"), C.synthetic_year_start(end).alias("start"), C.quarter_month(F.month("o_orderdate"), F.quarter("o_orderdate")).cast("int").alias("fiscal_month")).distinct()


@query(f"WITH {FACTS_SQL} SELECT entity, concept, \"end\", kind, val FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept, kind, \"end\" ORDER BY filed DESC) AS rn FROM facts WHERE filed <= DATE '2000-06-30') WHERE rn = 1")
def op_t26(spark: SparkSession, sf: str) -> DataFrame:
    return periods.as_known_at(facts(spark, sf), ["entity", "concept", "kind", "end"], "2000-06-30", "filed").select("entity", "concept", "end", "kind", "val")


_RATIO_COLS = ("ebitda", "fcf", "gross_margin", "operating_margin", "ebitda_margin", "net_margin", "roce", "debt_equity", "debt_ebitda", "net_debt_ebitda", "fcf_margin", "capex_revenue", "earnings_quality", "eps", "book_value_per_share", "fcf_on_net_capital")


@query(f"""WITH {WIDE_SQL}, x AS (SELECT *, operating_income + depreciation AS ebitda, cfo - capex AS fcf FROM wide)
SELECT entity, round(ebitda, 6) AS ebitda, round(fcf, 6) AS fcf, round(gross_profit / nullif(revenue, 0), 6) AS gross_margin, round(operating_income / nullif(revenue, 0), 6) AS operating_margin, round(ebitda / nullif(revenue, 0), 6) AS ebitda_margin,
round(net_income / nullif(revenue, 0), 6) AS net_margin, round(operating_income / nullif(equity + debt, 0), 6) AS roce, CASE WHEN equity > 0 THEN round(debt / equity, 6) END AS debt_equity, CASE WHEN ebitda > 0 THEN round(debt / ebitda, 6) END AS debt_ebitda,
CASE WHEN ebitda > 0 THEN round((debt - cash) / ebitda, 6) END AS net_debt_ebitda, round(fcf / nullif(revenue, 0), 6) AS fcf_margin, round(capex / nullif(revenue, 0), 6) AS capex_revenue, CASE WHEN net_income > 0 THEN round(cfo / net_income, 6) END AS earnings_quality,
round(nullif(net_income, 0) / nullif(shares, 0), 6) AS eps, round(equity / nullif(shares, 0), 6) AS book_value_per_share, round(fcf / nullif(equity + debt - cash, 0), 6) AS fcf_on_net_capital FROM x""")
def op_ratios_p6_p7_p8(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(ratios.with_ratios(wide(spark, sf)).select("entity", *_RATIO_COLS))


_RATES = "SELECT * FROM (VALUES ('ARS', 0.001), ('BRL', 0.2)) r(currency, rate)"
_VALUED = f"""{WIDE_SQL}, r AS ({_RATES}), v AS (SELECT wide.*, operating_income + depreciation AS ebitda, cfo - capex AS fcf, equity * 20 AS market_cap, CASE entity % 4 WHEN 0 THEN 'ARS' WHEN 1 THEN 'BRL' WHEN 2 THEN 'CLP' END AS currency FROM wide),
x AS (SELECT v.*, CASE WHEN coalesce(v.currency, 'USD') = 'USD' THEN 1.0::DOUBLE ELSE rate::DOUBLE END AS fx FROM v LEFT JOIN r ON v.currency = r.currency)"""


def _valued(spark: SparkSession, sf: str) -> DataFrame:
    currency = F.when(F.col("entity") % 4 == 0, "ARS").when(F.col("entity") % 4 == 1, "BRL").when(F.col("entity") % 4 == 2, "CLP")
    rates = spark.sql(_RATES.replace("0.001", "0.001D").replace("0.2)", "0.2D)"))
    rows = ratios.with_ratios(wide(spark, sf)).withColumns({"market_cap": F.col("equity") * 20, "currency": currency})
    return ratios.with_valuation(rows, rates)


@query(f"""WITH {_VALUED} SELECT entity, currency, fx, CASE WHEN net_income * fx > 0 THEN round(market_cap / (net_income * fx), 6) END AS per, CASE WHEN equity * fx > 0 THEN round(market_cap / (equity * fx), 6) END AS price_book,
CASE WHEN revenue * fx > 0 THEN round(market_cap / (revenue * fx), 6) END AS price_sales, CASE WHEN ebitda * fx > 0 THEN round((market_cap + debt * fx) / (ebitda * fx), 6) END AS ev_ebitda,
CASE WHEN market_cap > 0 THEN round(net_income * fx / market_cap, 6) END AS earnings_yield, CASE WHEN market_cap > 0 THEN round(fcf * fx / market_cap, 6) END AS fcf_yield FROM x""")
def op_valuation_j14(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_valued(spark, sf).select("entity", "currency", "fx", "per", "price_book", "price_sales", "ev_ebitda", "earnings_yield", "fcf_yield"))


@query(f"""WITH {_VALUED} SELECT entity, nullif(concat_ws(';', CASE WHEN entity % 5 = 0 THEN 'ni_fy' END, CASE WHEN equity < 0.05 * revenue THEN 'roe_ns' END, CASE WHEN coalesce(currency, 'USD') <> 'USD' AND fx IS NULL THEN 'no_fx' END,
CASE WHEN coalesce(currency, 'USD') = 'USD' AND abs(100 * shares - market_cap) / nullif(market_cap, 0) > 0.5 THEN 'mktcap_rev' END, CASE WHEN coalesce(currency, 'USD') <> 'USD' AND fx IS NOT NULL THEN 'fx_' || lower(currency) END), '') AS flags FROM x""")
def op_p21_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = ratios.quality_flags(F.when(F.col("entity") % 5 == 0, "C").otherwise("B"), F.col("equity"), F.col("revenue"), F.col("currency"), F.col("fx"), F.lit(100.0), F.col("shares"), F.col("market_cap"))
    return _valued(spark, sf).select("entity", flags.alias("flags"))


_DIV = """d AS (SELECT l_orderkey AS item, p_brand AS metric, l_extendedprice AS x, p_retailprice * l_quantity AS ref, (l_extendedprice - p_retailprice * l_quantity) / nullif(p_retailprice * l_quantity, 0) * 100 AS div FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _divergences(spark: SparkSession, sf: str) -> DataFrame:
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    ref = F.col("p_retailprice") * F.col("l_quantity")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(F.col("l_orderkey").alias("item"), F.col("p_brand").alias("metric"), F.col("l_extendedprice").alias("x"), ref.alias("ref"), C.relative_divergence("l_extendedprice", ref).alias("div"))


@query(f"""WITH {_DIV} SELECT metric, count(div) AS n, round(avg(div), 4) AS mean, round(stddev_samp(div), 4) AS sd, round(min(div), 4) AS least, round(max(div), 4) AS most, round(avg(abs(div)), 4) AS abs_mean, round(quantile_cont(abs(div), 0.5), 4) AS p50, round(quantile_cont(abs(div), 0.9), 4) AS p90, round(quantile_cont(abs(div), 0.95), 4) AS p95, round(quantile_cont(abs(div), 0.99), 4) AS p99,
round(100.0 * count(CASE WHEN abs(div) <= 5 THEN 1 END) / count(div), 4) AS within_5, round(100.0 * count(CASE WHEN abs(div) <= 10 THEN 1 END) / count(div), 4) AS within_10, round(100.0 * count(CASE WHEN abs(div) <= 20 THEN 1 END) / count(div), 4) AS within_20 FROM d GROUP BY metric""")
def op_a9_a11_a12_a13_c1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stats.divergence_summary(_divergences(spark, sf), "metric", "div"), 4)


@query(f"""WITH {_DIV}, p AS (SELECT metric, quantile_cont(abs(div), 0.95) AS p95, quantile_cont(abs(div), 0.99) AS p99 FROM d GROUP BY 1)
SELECT item, metric, round(div, 4) AS div, abs(div) >= p99 AS extreme FROM d JOIN p USING (metric) WHERE abs(div) >= p95""")
def op_c3(spark: SparkSession, sf: str) -> DataFrame:
    return stats.outliers(_divergences(spark, sf), "metric", "div").select("item", "metric", _r("div", 4).alias("div"), "extreme")


@query(f"""WITH {_DIV} SELECT metric, replace(printf('%+.2f', round(avg(div), 2)), '.', ',') || '%' AS shown FROM d GROUP BY 1""")
def op_c2(spark: SparkSession, sf: str) -> DataFrame:
    return _divergences(spark, sf).groupBy("metric").agg(F.round(F.avg("div"), 2).alias("m")).select("metric", C.divergence_text("m").alias("shown"))


@query("SELECT c_mktsegment AS grp, count(*) AS n, round(avg(c_acctbal), 4) AS mean, round(min(c_acctbal), 4) AS least, round(max(c_acctbal), 4) AS most, round(stddev_samp(c_acctbal), 4) AS sd, round(quantile_cont(c_acctbal, 0.25), 4) AS q1, round(quantile_cont(c_acctbal, 0.5), 4) AS q2, round(quantile_cont(c_acctbal, 0.75), 4) AS q3 FROM customer GROUP BY 1")
def op_a1_a10(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stats.describe_groups(table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "grp"), "grp", "c_acctbal"), 4)


@query("SELECT o_orderstatus AS status, CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_orderpriority END AS priority, count(*) AS n FROM orders GROUP BY 1, 2")
def op_a2_a5(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority"))
    return stats.group_sizes(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), priority.alias("priority")), ["status", "priority"])


@query("SELECT CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_orderpriority END AS priority, count(*) AS n FROM orders WHERE o_orderpriority NOT LIKE '5%' GROUP BY 1")
def op_a3(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority"))
    return stats.group_sizes(table(spark, sf, "orders").select(priority.alias("priority")), ["priority"], keep_null=False)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def op_a4(spark: SparkSession, sf: str) -> DataFrame:
    return stats.group_sizes(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).filter("n > 1")


@query("SELECT c_nationkey, count(DISTINCT c_mktsegment) AS segments, count(DISTINCT o_custkey) AS buyers, count(DISTINCT (o_orderstatus, o_orderpriority)) AS kinds FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def op_a6_a16(spark: SparkSession, sf: str) -> DataFrame:
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey).groupBy("c_nationkey").agg(F.count_distinct("c_mktsegment").alias("segments"), F.count_distinct("o_custkey").alias("buyers"), F.count_distinct(F.struct("o_orderstatus", "o_orderpriority")).alias("kinds"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def op_a7_o7(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("""WITH l AS (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) SELECT 'quality' AS metric, count(*) AS n, count(quality) AS filled, round(count(quality) * 100.0 / count(*), 6) AS percent, min(quality)::DOUBLE AS least, max(quality)::DOUBLE AS most, round(avg(quality), 6) AS mean FROM l
UNION ALL SELECT 'toxic', count(*), count(toxic), round(count(toxic) * 100.0 / count(*), 6), min(toxic)::DOUBLE, max(toxic)::DOUBLE, round(avg(toxic), 6) FROM l""")
def op_a8_a22_w12(spark: SparkSession, sf: str) -> DataFrame:
    both = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return _rounded(sinks.coverage_summary(both, ["quality", "toxic"]).withColumn("percent", F.col("percent").cast("double")))


@query("""WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS seq FROM customer GROUP BY 1, 2) SELECT c_nationkey, c_mktsegment AS mode FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, seq) AS rn FROM c) WHERE rn = 1""")
def op_a14(spark: SparkSession, sf: str) -> DataFrame:
    return stats.mode_first_seen(table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment", "c_custkey")


@query("""SELECT o_custkey, count(*) AS n, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS filled, min(year(o_orderdate))::INTEGER AS first_year, max(year(o_orderdate))::INTEGER AS last_year, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest, list_sort(list(DISTINCT o_orderpriority)) AS priorities FROM orders GROUP BY 1""")
def op_a18_a19_a21_j17(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("filled"), F.min(F.year("o_orderdate")).alias("first_year"), F.max(F.year("o_orderdate")).alias("last_year"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"), F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def op_a20(spark: SparkSession, sf: str) -> DataFrame:
    return stats.sample_groups(table(spark, sf, "orders"), "o_custkey", "o_orderkey", 3).select("o_custkey", "o_orderkey")


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE r_name LIKE 'A%'")
def op_j1_j2_j16(spark: SparkSession, sf: str) -> DataFrame:
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").filter(F.col("r_name").startswith("A")).select("c_custkey", "c_name", "n_name", "r_name")


@query("SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'no_row' WHEN toxic = 1 THEN 'error' ELSE 'matched' END AS state, CASE WHEN toxic = 0 THEN quality END AS quality FROM documents d LEFT JOIN labels l USING (doc_id)".replace("l.doc_id IS NULL", "l.toxic IS NULL"))
def op_j3_j4(spark: SparkSession, sf: str) -> DataFrame:
    left, right = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    return joins.matched_or_why(left, right, "doc_id", F.col("toxic") == 1).select("doc_id", "state", F.when(F.col("state") == "matched", F.col("quality")).alias("quality"))


@query("""WITH s AS (SELECT s_suppkey AS cik, 'T' || CAST(s_suppkey AS VARCHAR) || CASE s_suppkey % 3 WHEN 0 THEN '-B' ELSE '' END AS ticker FROM supplier), c AS (SELECT c_custkey, 'T' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN '.B' ELSE '' END AS ticker FROM customer),
v AS (SELECT c_custkey, ticker, 1 AS pos, ticker AS variant FROM c UNION ALL SELECT c_custkey, ticker, 2, replace(ticker, '.', '-') FROM c UNION ALL SELECT c_custkey, ticker, 3, split_part(ticker, '.', 1) FROM c UNION ALL SELECT c_custkey, ticker, 4, replace(ticker, '-', '.') FROM c)
SELECT c_custkey, ticker, variant AS matched_as, lpad(CAST(cik AS VARCHAR), 10, '0') AS cik FROM (SELECT v.c_custkey, v.ticker, v.variant, s.cik, row_number() OVER (PARTITION BY c_custkey ORDER BY pos) AS rn FROM v JOIN s ON v.variant = s.ticker) WHERE rn = 1""")
def op_j6_f3(spark: SparkSession, sf: str) -> DataFrame:
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    catalog = s.select(F.col("s_suppkey").alias("cik"), F.concat(F.lit("T"), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 3 == 0, "-B").otherwise("")).alias("ticker"))
    wanted = c.select("c_custkey", F.concat(F.lit("T"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, ".B").otherwise("")).alias("ticker"))
    return joins.variant_join(wanted, catalog, "c_custkey", "ticker").select("c_custkey", "ticker", "matched_as", C.padded_cik("cik").alias("cik"))


@query("SELECT c_custkey, 'listed' AS route FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'rejected' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def op_j8_i1(spark: SparkSession, sf: str) -> DataFrame:
    c, o = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    rejected = incremental.pending(c, o, ["c_custkey"])
    return c.join(o, "c_custkey", "left_semi").select("c_custkey", F.lit("listed").alias("route")).unionByName(rejected.select("c_custkey", F.lit("rejected").alias("route")))


@query("SELECT c_custkey, coalesce(CAST(s_suppkey AS VARCHAR), 'BYMA-' || c_name) AS cik FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def op_j9(spark: SparkSession, sf: str) -> DataFrame:
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return c.join(s, c.c_custkey == s.s_suppkey, "left").select("c_custkey", F.coalesce(F.col("s_suppkey").cast("string"), F.concat(F.lit("BYMA-"), "c_name")).alias("cik"))


@query(f"""WITH {_LATEST}, dp AS (SELECT *, date_diff('day', start, "end") + 1 AS d FROM latest) SELECT x.entity, x.concept, x.seq, y.seq AS prior_seq FROM dp x JOIN dp y ON x.entity = y.entity AND x.concept = y.concept AND x.seq <> y.seq AND date_diff('day', y."end", x."end") BETWEEN 350 AND 380 AND abs(x.d - y.d) <= 7""")
def op_j10(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.year_earlier_pairs(periods.latest_filed(facts(spark, sf))).select("entity", "concept", "seq", "prior_seq")


@query(f"""WITH {_ANNUAL}, i AS (SELECT entity, fy, val FROM annual WHERE concept LIKE '1%'), eq AS (SELECT entity, fy, val FROM annual WHERE concept LIKE '2%') SELECT i.entity, i.fy, round(i.val / nullif(eq.val, 0), 6) AS roe FROM i JOIN eq ON i.entity = eq.entity AND i.fy = eq.fy""")
def op_j13(spark: SparkSession, sf: str) -> DataFrame:
    annual = periods.annual_series(facts(spark, sf))
    side = lambda digit, name: annual.filter(F.col("concept").startswith(digit)).select("entity", "fy", F.col("val").alias(name))
    return side("1", "income").join(side("2", "equity"), ["entity", "fy"]).select("entity", "fy", _r(C.safe_ratio("income", "equity")).alias("roe"))


@query("SELECT o_custkey, o_totalprice AS val FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def op_j15(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.max_by("o_totalprice", F.struct("o_orderdate", -F.col("o_orderkey"))).alias("val"))


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def op_o1(spark: SparkSession, sf: str) -> DataFrame:
    return screen.top(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 10, "p_partkey")


@query(f"""WITH {WIDE_SQL}, m AS (SELECT entity, 'net_margin' AS ranking, net_income / nullif(revenue, 0) AS value FROM wide UNION ALL SELECT entity, 'roe', CASE WHEN equity > 0 THEN net_income / equity END FROM wide)
SELECT ranking, entity, round(value, 6) AS value, rank FROM (SELECT *, row_number() OVER (PARTITION BY ranking ORDER BY value DESC, entity) AS rank FROM m WHERE value IS NOT NULL) WHERE rank <= 5""")
def op_o2_o3(spark: SparkSession, sf: str) -> DataFrame:
    w = wide(spark, sf).select("entity", C.safe_ratio("net_income", "revenue").alias("net_margin"), C.guarded_ratio("net_income", "equity").alias("roe"))
    return _rounded(screen.rankings(w, "entity", ["net_margin", "roe"], 5))


@query("SELECT l_orderkey, l_extendedprice, rn FROM (SELECT DISTINCT l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber, l_quantity) AS rn FROM lineitem) WHERE rn <= 3")
def op_o4(spark: SparkSession, sf: str) -> DataFrame:
    rn = F.row_number().over(W.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", rn.alias("rn")).filter("rn <= 3")


@query("SELECT c_name AS name, 'customer' AS tipo, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, 'supplier', s_acctbal, NULL FROM supplier")
def op_o6_p1_p2_p3_w6(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("tipo"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("tipo"), F.col("s_acctbal").alias("balance"))
    return sinks.union_header([c, s], ["name", "tipo"])


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'F' AND year(o_orderdate) BETWEEN 1996 AND 1998")
def op_p5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") != "F") & (F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1999-01-01")).select("o_orderkey")


@query(f"WITH {WIDE_SQL} SELECT entity, CASE WHEN coalesce(debt, cash, NULL) IS NOT NULL THEN round(coalesce(debt, 0) + coalesce(cash, 0) + coalesce(coalesce(nullif(0, 0), capex), 0), 2) ELSE round(capex, 2) END AS debt FROM wide")
def op_p9_p10(spark: SparkSession, sf: str) -> DataFrame:
    return wide(spark, sf).select("entity", _r(C.total_debt("debt", "cash", F.lit(0.0), "capex"), 2).alias("debt"))


@query("SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS sic, CASE WHEN g BETWEEN 1 AND 9 THEN 'Agro/Minería primaria' WHEN g BETWEEN 10 AND 14 THEN 'Minería/Energía extractiva' WHEN g BETWEEN 15 AND 17 THEN 'Construcción' WHEN g BETWEEN 20 AND 39 THEN 'Manufactura/Industria' WHEN g BETWEEN 40 AND 49 THEN 'Transporte/Utilities/Telecom' WHEN g BETWEEN 50 AND 51 THEN 'Comercio mayorista' WHEN g BETWEEN 52 AND 59 THEN 'Comercio minorista' WHEN g BETWEEN 60 AND 67 THEN 'Finanzas/Seguros/Inmobiliario' WHEN g BETWEEN 70 AND 89 THEN 'Servicios' ELSE 'Otro' END AS sector FROM (SELECT p_partkey, CAST(substr(CAST(p_partkey AS VARCHAR), 1, 2) AS INTEGER) AS g FROM part)")
def op_p11(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sic")).distinct().withColumn("sector", C.sic_sector("sic"))


@query("SELECT n_nationkey, CASE WHEN r_name = 'AMERICA' THEN 'latam' WHEN r_name IN ('EUROPE', 'ASIA') THEN 'us_other' ELSE 'otro' END AS grupo, CASE r_name WHEN 'AMERICA' THEN 0 WHEN 'EUROPE' THEN 1 ELSE 2 END AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
def op_p13_p14_p15(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    group = F.when(F.arrays_overlap(F.array("r_name"), F.array(F.lit("AMERICA"))), "latam").when(F.col("r_name").isin("EUROPE", "ASIA"), "us_other").otherwise("otro")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", group.alias("grupo"), F.when(F.col("r_name") == "AMERICA", 0).when(F.col("r_name") == "EUROPE", 1).otherwise(2).alias("place"))


_RULES = [("(?i)brass", "metal", 90), ("(?i)^standard", "standard", 70), ("(?i)plated|polished", "finish", 50)]


@query("SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(?i)brass') THEN 'metal' WHEN regexp_matches(p_type, '(?i)^standard') THEN 'standard' WHEN regexp_matches(p_type, '(?i)plated|polished') THEN 'finish' ELSE 'other' END AS label, CASE WHEN regexp_matches(p_type, '(?i)brass') THEN 90 WHEN regexp_matches(p_type, '(?i)^standard') THEN 70 WHEN regexp_matches(p_type, '(?i)plated|polished') THEN 50 ELSE 0 END AS score FROM part")
def op_p16(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", C.first_match("p_type", _RULES).alias("m")).select("p_partkey", "m.label", "m.score")


@query("SELECT page_id, CASE WHEN coalesce(length(html), 0) = 0 THEN 'empty_response' WHEN length(html) < 2000 THEN 'html_too_small' WHEN regexp_matches(lower(html), 'captcha|recaptcha|cloudflare|cf-browser-verification|verify you are human') THEN 'captcha' WHEN regexp_matches(lower(html), 'maintenance|mantenimiento|temporarily unavailable|service unavailable|503') THEN 'maintenance' WHEN regexp_matches(lower(html), '404|not found|ha ocurrido un error|ocurrió un error|error interno|internal server error') THEN 'error_page' ELSE 'ok' END AS state FROM pages")
def op_p18_f15(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", C.page_fault("html", least=2000).alias("state"))


@query("SELECT page_id, len(regexp_extract_all(html, '<p[ >]')) AS paragraphs, len(regexp_extract_all(html, '<li[ >]')) AS items, len(regexp_extract_all(html, '<script')) AS scripts, regexp_extract(html, '<title>([^<]*)', 1) AS title, list_sort(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS links FROM pages")
def op_f12_f13_f14(spark: SparkSession, sf: str) -> DataFrame:
    count = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    links = F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))))
    return table(spark, sf, "pages").select("page_id", count("<p[ >]").alias("paragraphs"), count("<li[ >]").alias("items"), count("<script").alias("scripts"), F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), links.alias("links"))


@query("SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')) AS text FROM pages")
def op_f7(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", C.plain_text("html").alias("text"))


def _event_k(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 2 = 0")
def op_s6_f26(spark: SparkSession, sf: str) -> DataFrame:
    return _event_k(table(spark, sf, "events").filter("event_id % 2 = 0"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def op_s6_f26_all(spark: SparkSession, sf: str) -> DataFrame:
    return _event_k(table(spark, sf, "events"))


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, 'the|que|der'))) AS hits FROM documents")
def op_f23(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike("the|que|der"))).cast("long").alias("hits"))


@query("""WITH t AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '(' || printf('%d', p_partkey) || '.000,5)' WHEN 1 THEN printf('%d', p_partkey) || ',25%' ELSE 'n/d' END AS s FROM part)
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN -(p_partkey * 1000 + 0.5) WHEN 1 THEN p_partkey + 0.25 END::DOUBLE AS ar, CASE p_partkey % 3 WHEN 1 THEN p_partkey + 0.25 END::DOUBLE AS pct FROM t""")
def op_f4_f5(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    text = F.when(key % 3 == 0, F.concat(F.lit("("), key.cast("string"), F.lit(".000,5)"))).when(key % 3 == 1, F.concat(key.cast("string"), F.lit(",25%"))).otherwise("n/d")
    return table(spark, sf, "part").select("p_partkey", C.argentine_number(text).alias("ar"), C.percent_number(text).alias("pct"))


_EV = """e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS last, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS first FROM events)"""


def _early_late(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The events up to the median of ts and those after it; all of one ts are on one side."""
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    cut = ev.join(F.broadcast(ev.agg(F.percentile_approx("ts", 0.5).alias("_cut"))))
    late = F.coalesce(F.col("ts") > F.col("_cut"), F.lit(False))
    return cut.filter(~late).drop("_cut"), cut.filter(late).drop("_cut")


@query(f"WITH {_EV} SELECT user_id, event_type, event_id, value FROM e WHERE last = 1")
def op_w1(spark: SparkSession, sf: str) -> DataFrame:
    early, late = _early_late(spark, sf)
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    existing = sinks.upsert(early.limit(0), early, keys, order)
    return sinks.upsert(existing, late, keys, order).select("user_id", "event_type", "event_id", "value")


@query(f"WITH {_EV} SELECT user_id, event_type, event_id, value FROM e WHERE first = 1")
def op_w2(spark: SparkSession, sf: str) -> DataFrame:
    early, late = _early_late(spark, sf)
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    existing = sinks.insert_new(early.limit(0), early, keys, order)
    return sinks.insert_new(existing, late, keys, order).select("user_id", "event_type", "event_id", "value")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, s_name) AS name, CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS balance FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def op_w3(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return sinks.update_missing(c, s, ["c_custkey"], ["name"])


@query(f"""WITH {WIDE_SQL}, x AS (SELECT entity, abs(gross_profit + operating_income - revenue) / nullif(abs(revenue), 0) * 100 AS gap FROM wide) SELECT entity, round(gap, 4) AS gap, gap < 60 AS accepted FROM x""")
def op_c6(spark: SparkSession, sf: str) -> DataFrame:
    gap = C.identity_gap("revenue", "gross_profit", "operating_income")
    return wide(spark, sf).select("entity", _r(gap, 4).alias("gap"), (gap < 60).alias("accepted"))


@query(f"""WITH {_DIV}, s AS (SELECT metric, sum(CAST(x AS DECIMAL(18,2))) AS x, sum(CAST(ref AS DECIMAL(18,2))) AS ref FROM d GROUP BY 1) SELECT metric, round(CAST(x AS DOUBLE) / 2, 4) AS implied, round((CAST(x AS DOUBLE) / 2 - CAST(ref AS DOUBLE)) / CAST(ref AS DOUBLE) * 100, 4) AS diff, CASE WHEN abs((CAST(x AS DOUBLE) / 2 - CAST(ref AS DOUBLE)) / CAST(ref AS DOUBLE) * 100) <= 10 THEN 'input explains it' ELSE 'input does not explain it' END AS hypothesis FROM s""")
def op_c4_c5(spark: SparkSession, sf: str) -> DataFrame:
    s = _divergences(spark, sf).groupBy("metric").agg(F.sum(F.col("x").cast("decimal(18,2)")).cast("double").alias("x"), F.sum(F.col("ref").cast("decimal(18,2)")).cast("double").alias("ref"))
    return _rounded(stats.implied_input(s, F.col("x"), F.lit(2.0), F.col("ref")).select("metric", "implied", "diff", "hypothesis"), 4)


@query("SELECT p_partkey, p_name, p_retailprice, p_size FROM part WHERE p_size BETWEEN 10 AND 20 AND p_retailprice >= 1000 AND p_name ILIKE '%1%' ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def op_q1(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    return screen.screen(parts, {"p_size": (10, 20), "p_retailprice": (1000, None)}, {"p_name": "1"}, [("p_retailprice", False), ("p_partkey", True)], 25)


@query("SELECT CAST(CASE WHEN p_retailprice < 900 THEN 0 WHEN p_retailprice >= 2100 THEN 13 ELSE floor((p_retailprice - 900) / 100) + 1 END AS BIGINT) AS bucket, count(*) AS n FROM part GROUP BY 1")
def op_q2(spark: SparkSession, sf: str) -> DataFrame:
    return screen.histogram(table(spark, sf, "part"), "p_retailprice", 900, 2100, 12)


@query("SELECT p_partkey, NOT (p_size > 40 OR p_retailprice > 1900) AS kept FROM part")
def op_q3(spark: SparkSession, sf: str) -> DataFrame:
    return screen.within_limits(table(spark, sf, "part"), {"p_size": 40, "p_retailprice": 1900}).select("p_partkey", "kept")


@query(f"""WITH {_TTM}, t AS (SELECT entity, sum(CAST(value AS DECIMAL(18,2))) AS ttm FROM ttm GROUP BY 1) SELECT entity, CAST(ttm AS DOUBLE) AS ttm, round(CAST(ttm AS DOUBLE) / count(c_custkey), 4) AS per_customer FROM t JOIN customer ON c_nationkey = entity GROUP BY entity, ttm ORDER BY ttm DESC, entity LIMIT 10""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The entities with the largest trailing twelve months, and that for each customer."""
    ttm = periods.trailing_twelve_months(periods.latest_filed(facts(spark, sf)))
    total = ttm.groupBy("entity").agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("ttm"))
    customers = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("entity")).agg(F.count(F.lit(1)).alias("n"))
    out = total.join(customers, "entity").select("entity", F.col("ttm").cast("double").alias("ttm"), _r(F.col("ttm").cast("double") / F.col("n"), 4).alias("per_customer"))
    return screen.top(out, "ttm", 10, "entity")

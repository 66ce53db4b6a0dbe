"""Queries over labels, states, notes, searches, and variants of ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import joins, ratios, screen
from ledgerline.plans.base import query, rounded
from ledgerline.plans.facts import WIDE_SQL, wide
from ledgerline.session import table


@query("SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 END::INTEGER AS is_statement FROM part")
def op_p17(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 4 == 0, "Memoria y balance anual").when(k % 4 == 1, "Acta de Directorio").when(k % 4 == 2, "informaci\u00f3n financiera").otherwise("Otros")
    return table(spark, sf, "part").select(k.alias("k"), C.keyword_class(name, C.STATEMENT_FORMS, C.OTHER_FORMS).alias("is_statement"))


@query("SELECT p_partkey AS k, ['Feature', 'Bug Fix', 'Documentation', 'Refactor', 'Test', 'Other'][1 + p_partkey % 6] AS kind, [100, 50, 0][1 + p_partkey % 3]::INTEGER AS progress FROM part")
def op_p19_p20(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    message = F.concat(F.element_at(F.array(*map(F.lit, ("feat: ", "fixes ", "docs(x): ", "refactor!", "tests of ", "Feature "))), (k % 6 + 1).cast("int")), k.cast("string"))
    state = F.element_at(F.array(*map(F.lit, ("COMPLETADA", "EN PROGRESO", "PENDIENTE"))), (k % 3 + 1).cast("int"))
    return table(spark, sf, "part").select(k.alias("k"), C.prefix_class(message).alias("kind"), C.progress(state).alias("progress"))


@query(f"""WITH {WIDE_SQL} SELECT entity, concat_ws('; ', CASE WHEN entity % 5 = 0 THEN 'STALE' END, CASE WHEN entity % 3 = 0 THEN 'annual income' END, CASE WHEN equity < 0.05 * revenue THEN 'equity under 5 %' END, CASE WHEN debt IS NULL THEN 'no debt' END) AS notes,
CASE WHEN entity % 7 = 0 THEN 'OK' WHEN entity % 4 > 0 THEN 'PARCIAL' WHEN entity % 2 = 0 AND entity < 10 THEN 'ESCANEADO' ELSE 'VACIO' END AS state FROM wide""")
def op_p22_p23(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("entity")
    notes = C.joined_notes({"STALE": e % 5 == 0, "annual income": e % 3 == 0, "equity under 5 %": F.col("equity") < 0.05 * F.col("revenue"), "no debt": F.col("debt").isNull()})
    state = C.extraction_state(F.when(e % 7 == 0, True), e % 4, e < 10)
    return wide(spark, sf).select("entity", notes.alias("notes"), state.alias("state"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND (o_orderstatus = 'F' OR (CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END) IS NULL) AND (CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey END) IS NOT NULL")
def op_p4_p5(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").withColumns({"a": F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")), "b": F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey"))})
    kept = rows.filter(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ((F.col("o_orderstatus") == "F") | F.col("a").isNull()) & F.col("b").isNotNull())
    return C.existing(kept, ["o_orderkey", "o_comment", "o_orderpriority"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'recycled ticker' END AS reason, s_name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey AND c_custkey % 10 <> 3""")
def op_j7(spark: SparkSession, sf: str) -> DataFrame:
    c, s = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    excluded = c.filter("c_custkey % 10 = 3").withColumn("reason", F.lit("recycled ticker"))
    kept, rejected = joins.route_excluded(c, excluded, "c_custkey")
    return kept.join(s, "c_custkey", "left").withColumn("reason", F.lit(None).cast("string")).unionByName(rejected.withColumn("s_name", F.lit(None).cast("string"))).select("c_custkey", "reason", "s_name")


@query("SELECT c_custkey, round((c_acctbal - s_acctbal) / s_acctbal * 100, 6) AS div FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE s_suppkey % 4 <> 0 AND s_acctbal <> 0 AND c_custkey % 3 <> 0")
def op_j5(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("x"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("ref"), F.when(F.col("s_suppkey") % 4 == 0, "timeout").alias("_error"))
    return rounded(joins.usable_pairs(c, s, "c_custkey", ("x", "ref"), F.col("_error").isNotNull()).select("c_custkey", C.relative_divergence("x", "ref").alias("div")))


@query("""SELECT c_nationkey AS nation, c_custkey, s_suppkey FROM customer LEFT JOIN (SELECT s_nationkey, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS rn FROM supplier WHERE s_acctbal > 2000) WHERE rn = 1) ON c_nationkey = s_nationkey""")
def op_s16(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), "s_name", "s_suppkey", "s_acctbal")
    hits = joins.first_hit(c.distinct(), s, "nation", F.col("s_acctbal") > 2000, ["s_name", "s_suppkey"])
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey").join(hits.select("nation", "s_suppkey"), "nation")


@query("""WITH t AS (SELECT *, count(*) OVER w AS examined, count(*) FILTER (o_orderstatus = 'F') OVER w AS matched FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey ROWS UNBOUNDED PRECEDING))
SELECT o_custkey, o_orderkey FROM t WHERE o_orderstatus = 'F' AND examined <= 6 AND matched <= 2""")
def op_o8(spark: SparkSession, sf: str) -> DataFrame:
    scan = joins.bounded_scan(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], F.col("o_orderstatus") == "F", 2, 6)
    return scan.select("o_custkey", "o_orderkey")


@query("""WITH c AS (SELECT p_partkey AS k, p_retailprice AS rev, CASE p_partkey % 2 WHEN 0 THEN -p_size ELSE p_size END::DOUBLE AS cogs, p_retailprice - p_size + (p_partkey % 7) AS gross FROM part)
SELECT k, round(abs(rev - abs(cogs) - gross) / nullif(abs(gross), 0) * 100, 6) AS gap, abs(rev - abs(cogs) - gross) / nullif(abs(gross), 0) * 100 < 0.2 AS accepted FROM c""")
def op_c6_gross(spark: SparkSession, sf: str) -> DataFrame:
    k, price, size = F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size").cast("double")
    gap = C.gross_gap("rev", "cogs", "gross")
    rows = table(spark, sf, "part").select(k.alias("k"), price.alias("rev"), F.when(k % 2 == 0, -size).otherwise(size).alias("cogs"), (price - size + k % 7).alias("gross"))
    return rounded(rows.select("k", gap.alias("gap"), (gap < 0.2).alias("accepted")))


@query("SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 10 WHEN 1 THEN p_size * 6 WHEN 2 THEN p_size WHEN 3 THEN p_size ELSE 0 END::DOUBLE AS income FROM part")
def op_c7(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("double")
    net = F.when(k % 5 == 0, None).when(k % 5 == 4, 0.0).otherwise(size)
    total = F.when(k % 5 == 0, 10.0).when(k % 5 == 1, -size * -6).when(k % 5 == 2, size * 5).when(k % 5 == 4, 3.0)
    return table(spark, sf, "part").select(k.alias("k"), net.alias("net"), total.alias("total")).select("k", C.reconciled_income("net", "total").alias("income"))


@query("""WITH s AS (SELECT n_nationkey, lower(n_name) AS a, list_aggregate(list_sort(string_split(lower(r_name || ' of ' || n_name), ' ')), 'string_agg', ' ') AS x FROM nation JOIN region ON n_regionkey = r_regionkey),
o AS (SELECT n_nationkey AS other, list_aggregate(list_sort(string_split(lower(n_name || ' of ' || r_name), ' ')), 'string_agg', ' ') AS y, r_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT s.n_nationkey, other, round(100 * (1 - levenshtein(x, y) / greatest(length(x), length(y), 1)), 4) AS score FROM s JOIN nation n ON n.n_nationkey = s.n_nationkey JOIN o ON o.r_regionkey = n.n_regionkey)
SELECT n_nationkey, arg_max(other, (score, -other)) AS best, max(score) AS score FROM c GROUP BY 1""")
def op_c8(spark: SparkSession, sf: str) -> DataFrame:
    """Each nation's best match by sorted tokens among the names of its region."""
    both = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = both.select("n_nationkey", "n_regionkey", F.concat_ws(" of ", "r_name", "n_name").alias("a"))
    b = both.select(F.col("n_nationkey").alias("other"), "n_regionkey", F.concat_ws(" of ", "n_name", "r_name").alias("b"))
    scored = a.join(b, "n_regionkey").select("n_nationkey", "other", C.token_similarity("a", "b").alias("score"))
    return scored.groupBy("n_nationkey").agg(F.max_by("other", F.struct(F.col("score"), -F.col("other"))).alias("best"), F.max("score").alias("score"))


_METRICS = ("PER", "EPS", "Margen", "ROE", "Payout", "CrecEPS")


@query(f"""WITH {WIDE_SQL}, m AS (SELECT entity, metric, (entity + 1) / 10.0::DOUBLE AS v, revenue, net_income, equity, capex, shares FROM wide, (VALUES {", ".join(f"('{m}')" for m in _METRICS)}) t(metric)),
i AS (SELECT *, CASE metric WHEN 'PER' THEN 50 / v * shares WHEN 'EPS' THEN v * shares WHEN 'Margen' THEN v * revenue WHEN 'ROE' THEN net_income / v WHEN 'Payout' THEN v * net_income END AS implied,
CASE metric WHEN 'PER' THEN net_income WHEN 'EPS' THEN net_income WHEN 'Margen' THEN net_income WHEN 'ROE' THEN equity WHEN 'Payout' THEN capex END AS actual FROM m)
SELECT entity, metric, round(implied, 4) AS implied, round(actual, 4) AS actual, round((implied - actual) / nullif(actual, 0) * 100, 4) AS diff FROM i""")
def op_c4(spark: SparkSession, sf: str) -> DataFrame:
    w = wide(spark, sf).withColumns({"price": F.lit(50.0), "average_equity": F.col("equity"), "dividends": F.col("capex"), "metric": F.explode(F.array(*map(F.lit, _METRICS)))})
    found = w.select("entity", "metric", ratios.implied_by(F.col("metric"), (F.col("entity") + 1) / F.lit(10.0)).alias("i")).select("entity", "metric", "i.*")
    return rounded(found.withColumn("diff", C.relative_divergence("implied", "actual")), 4)


@query(f"""WITH {WIDE_SQL} SELECT entity, round(net_income + depreciation + capex + cash, 4) AS ebitda, round(depreciation, 4) AS da, CASE WHEN entity % 3 = 0 THEN 'shares_descartadas_escala' END AS flag, CASE WHEN entity % 3 > 0 THEN round(shares, 4) END AS diluted FROM wide""")
def op_r_backend_t20(spark: SparkSession, sf: str) -> DataFrame:
    diluted, shares = F.when(F.col("entity") % 3 == 0, F.col("shares") * 1_000).otherwise(F.col("shares")), F.col("shares")
    return rounded(wide(spark, sf).select("entity", ratios.four_part_ebitda("net_income", "depreciation", "capex", "cash").alias("ebitda"), F.col("depreciation").alias("da"), ratios.plausible_shares_flag(diluted, shares).alias("flag"), ratios.plausible_shares(diluted, shares).alias("diluted")), 4)


@query(f"""WITH {WIDE_SQL}, x AS (SELECT *, CASE entity % 4 WHEN 0 THEN cfo END AS whole, CASE WHEN entity % 4 <> 1 THEN capex END AS first, depreciation AS second, CASE WHEN entity % 2 = 0 THEN 1000.0::DOUBLE END AS extra FROM wide)
SELECT entity, round(CASE WHEN whole IS NOT NULL THEN whole WHEN second >= first OR first IS NULL THEN second + coalesce(extra, 0) ELSE first END, 4) AS da FROM x""")
def op_t7(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("entity")
    da = ratios.depreciation(F.when(e % 4 == 0, F.col("cfo")), F.when(e % 4 != 1, F.col("capex")), F.col("depreciation"), F.lit(True), F.when(e % 2 == 0, F.lit(1000.0)))
    return rounded(wide(spark, sf).select("entity", da.alias("da")), 4)


@query(f"""WITH {WIDE_SQL}, x AS (SELECT *, 40.0::DOUBLE AS price, equity * 3 AS market_cap, debt * 2 AS liabilities, operating_income + depreciation AS ebitda, cfo - capex AS fcf FROM wide)
SELECT entity, CASE WHEN net_income / shares > 0 THEN round(price / (net_income / shares), 6) END AS pe, CASE WHEN equity > 0 THEN round(price / (equity / shares), 6) END AS p_book, CASE WHEN equity > 0 THEN round(liabilities / equity, 6) END AS debt_equity,
CASE WHEN ebitda > 0 THEN round(liabilities / ebitda, 6) END AS debt_ebitda, CASE WHEN revenue > 0 THEN round(net_income / revenue, 6) END AS margin_neto, CASE WHEN equity > 0 THEN round(net_income / equity, 6) END AS roe, CASE WHEN revenue > 0 THEN round(operating_income / revenue, 6) END AS op_margin,
CASE WHEN revenue > 0 THEN round(ebitda / revenue, 6) END AS ebitda_margin, CASE WHEN fcf > 0 AND market_cap > 0 THEN round(fcf / market_cap, 6) END AS fcf_yield, 0.02::DOUBLE AS payout_ratio, NULL::DOUBLE AS current_ratio, NULL::DOUBLE AS eps_cagr_5y FROM x""")
def op_r_screener(spark: SparkSession, sf: str) -> DataFrame:
    x = wide(spark, sf).withColumns({"price": F.lit(40.0), "market_cap": F.col("equity") * 3, "liabilities": F.col("debt") * 2, "ebitda": F.col("operating_income") + F.col("depreciation"), "fcf": F.col("cfo") - F.col("capex"), "diluted_shares": F.col("shares"), "dividend_yield": F.lit(0.02)})
    return rounded(x.select("entity", *[c.alias(n) for n, c in ratios.screener_ratios().items()]))


@query(f"""WITH {WIDE_SQL} SELECT entity, round(gross_profit / nullif(revenue, 0), 6) AS margen_bruto, round(net_income / nullif(revenue, 0), 6) AS margen_neto, round(net_income / nullif(equity, 0), 6) AS roe, round(net_income / nullif(cfo, 0), 6) AS roa, round(cash / nullif(debt, 0), 6) AS current_ratio, round(coalesce(debt, 0) / nullif(operating_income, 0), 6) AS deuda_ebitda FROM wide""")
def op_r_template(spark: SparkSession, sf: str) -> DataFrame:
    x = wide(spark, sf).withColumns({"assets": F.col("cfo"), "current_assets": F.col("cash"), "current_liabilities": F.col("debt"), "debt_current": F.lit(None).cast("double"), "debt_non_current": F.col("debt"), "ebitda": F.col("operating_income")})
    return rounded(x.select("entity", *[c.alias(n) for n, c in ratios.template_ratios().items()]))


_REST = ("roe", "roa", "current_ratio", "quick_ratio", "asset_turnover", "inventory_turnover", "days_receivable", "payout", "fcf_payout", "fcf_on_long_capital")


@query(f"""WITH {WIDE_SQL}, x AS (SELECT *, cfo - capex AS fcf FROM wide) SELECT entity, CASE WHEN equity > 0 THEN round(net_income / equity, 6) END AS roe, round(net_income / nullif(cfo, 0), 6) AS roa, round(cash / nullif(debt, 0), 6) AS current_ratio, round((cash - capex) / nullif(debt, 0), 6) AS quick_ratio, round(revenue / nullif(cfo, 0), 6) AS asset_turnover,
round((revenue - gross_profit) / nullif(capex, 0), 6) AS inventory_turnover, round(depreciation / nullif(revenue, 0) * 365, 6) AS days_receivable, CASE WHEN net_income > 0 THEN round(debt / net_income, 6) END AS payout, CASE WHEN fcf > 0 THEN round(debt / fcf, 6) END AS fcf_payout, round(fcf / nullif(equity + cash, 0), 6) AS fcf_on_long_capital FROM x""")
def op_ratios_rest(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    x = wide(spark, sf).withColumns({"average_equity": c("equity"), "assets": c("cfo"), "current_assets": c("cash"), "current_liabilities": c("debt"), "inventory": c("capex"), "receivables": c("depreciation"), "dividends": c("debt"), "long_debt": c("cash")})
    return rounded(ratios.with_ratios(x).select("entity", *_REST))


@query("SELECT p_partkey, p_name, p_retailprice, p_size FROM part WHERE p_size BETWEEN 10 AND 40 AND p_retailprice >= 920 AND p_name ILIKE '%r%' ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def op_q1_rows(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    return screen.screen(parts, {"p_size": (10, 40), "p_retailprice": (920, None)}, {"p_name": "R"}, [("p_retailprice", False), ("p_partkey", True)], 25)


@query("SELECT CAST(CASE WHEN p_retailprice < 910 THEN 0 WHEN p_retailprice >= 990 THEN 9 ELSE floor((p_retailprice - 910) / 10) + 1 END AS BIGINT) AS bucket, count(*) AS n FROM part GROUP BY 1")
def op_q2_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return screen.histogram(table(spark, sf, "part"), "p_retailprice", 910, 990, 8)

"""Queries that write tables in the shared folder in one of the sources' shapes and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import ratios
from ledgerline.plans.base import query, rounded
from ledgerline.plans.facts import FACTS_SQL, WIDE_SQL, facts, wide
from ledgerline.session import scratch, table
from ledgerline.sources import readers, sinks
from ledgerline.streaming import incremental


@query("SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS segment FROM customer")
def op_s1_w5(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("segment"))
    sinks.recreate(rows.limit(1), path, "csv")
    sinks.recreate(rows, path, "csv")
    return readers.read_csv(spark, path, "c_custkey long, c_name string, c_acctbal double, segment string")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN printf('%.2f', s_acctbal) END AS balance, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS number FROM supplier UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 0")
def op_s2_w7(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends; all columns come back as text and are cast late."""
    path = scratch(spark)
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, F.format_string("%.2f", "s_acctbal")).alias("balance"))
    sinks.append_csv(rows, path)
    sinks.append_csv(rows.filter("s_suppkey % 4 = 0").withColumn("balance", F.lit(None).cast("string")), path)
    return readers.read_csv_text(spark, path).withColumn("number", F.col("balance").try_cast("double"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS c0, n_name || ' \u20ac \u00f3' AS c1, n_regionkey || ',5' AS c2 FROM nation")
def op_s3(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet with semicolons in the Windows code page."""
    path = scratch(spark)
    sheet = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string"), F.concat("n_name", F.lit(" \x80 \u00f3")), F.concat(F.col("n_regionkey").cast("string"), F.lit(",5")))
    sheet.coalesce(1).write.options(sep=";", encoding="ISO-8859-1").csv(path)  # 25 rows
    return readers.read_sheet(spark, path, 20, 30, [], 3).select("c0", "c1", "c2")


@query("SELECT 'now' AS timestamp, 'T' || p_partkey AS ticker, p_retailprice AS last_price, CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE END AS market_cap FROM part")
def op_s4(spark: SparkSession, sf: str) -> DataFrame:
    """One document for every thousand tickers."""
    path = scratch(spark)
    price = F.struct(F.col("p_retailprice").alias("last_price"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("double")).alias("market_cap"))
    pairs = table(spark, sf, "part").select(F.floor(F.col("p_partkey") / 1000).alias("file"), F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("t"), price.alias("p"))
    docs = pairs.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("t", "p"))).alias("precios"))
    docs.select("file", F.lit("now").alias("timestamp"), "precios").write.partitionBy("file").json(path)  # a file each
    return readers.read_prices(spark, path).select("timestamp", "ticker", "last_price", "market_cap")


@query("SELECT s_suppkey AS cik, s_name AS ticker, CASE WHEN s_suppkey % 2 = 0 THEN 'timeout' END AS error FROM supplier")
def op_s5(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cik"), F.col("s_name").alias("ticker"), F.when(F.col("s_suppkey") % 2 == 0, "timeout").alias("error"))
    rows.groupBy((F.col("cik") % 3).alias("file")).agg(F.to_json(F.collect_list(F.struct("cik", "ticker", "error"))).alias("value")).select("value").repartition(3).write.option("lineSep", "\n").text(path)
    return readers.read_json_list(spark, path, "cik long, ticker string, error string")


@query(f"""WITH {FACTS_SQL} SELECT CAST(entity AS VARCHAR) AS cik, 'us-gaap' AS taxonomy, concept AS tag, 'USD' AS unit, start, "end", val, form FROM facts WHERE kind <> 2 AND "end" >= DATE '1998-12-31' - 1500""")
def op_s6(spark: SparkSession, sf: str) -> DataFrame:
    """Facts as one document for each entity, then flattened: year-to-date rows have a form without statements."""
    text = lambda c: F.col(c).cast("string").alias(c)
    form = F.when(F.col("kind") == 2, "8-K").otherwise(F.col("form")).alias("form")
    points = facts(spark, sf).select("entity", "concept", F.struct(text("start"), text("end"), "val", "fy", F.lit(None).cast("string").alias("fp"), form, text("filed")).alias("p"))
    tags = points.groupBy("entity", "concept").agg(F.collect_list("p").alias("USD")).select("entity", F.struct(F.col("concept").alias("key"), F.struct(F.struct("USD").alias("units")).alias("value")).alias("tag"))
    docs = tags.groupBy("entity").agg(F.map_from_entries(F.collect_list("tag")).alias("us-gaap")).select(F.col("entity").cast("string").alias("cik"), F.to_json(F.struct("us-gaap")).alias("facts"))
    return readers.company_facts(docs, "1998-12-31", 1500).select("cik", "taxonomy", "tag", "unit", "start", "end", "val", "form")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS cik, s_name AS name FROM supplier")
def op_s8(spark: SparkSession, sf: str) -> DataFrame:
    row = F.array(F.col("s_name"), F.lit("x"), F.col("s_suppkey").cast("string"))
    docs = table(spark, sf, "supplier").groupBy((F.col("s_suppkey") % 4).alias("doc")).agg(F.to_json(F.struct(F.array(*map(F.lit, ("name", "exchange", "cik"))).alias("fields"), F.collect_list(row).alias("data"))).alias("json"))
    return readers.columnar_json(docs, "json", ["cik", "name"])


@query("SELECT CAST(p_partkey % 50 AS INTEGER) AS page, p_partkey AS part, p_name AS name, p_size::VARCHAR AS size FROM part")
def op_s9(spark: SparkSession, sf: str) -> DataFrame:
    cell = lambda x: F.concat(F.lit("<td class='c'> <b>"), x, F.lit("</b>\n</td>"))
    row = F.concat(F.lit("<TR>"), cell(F.col("p_partkey").cast("string")), cell(F.col("p_name")), cell(F.col("p_size").cast("string")), F.lit("</TR>\n"))
    pages = table(spark, sf, "part").groupBy((F.col("p_partkey") % 50).cast("int").alias("page")).agg(F.concat(F.lit("<p>x</p><table><tbody>"), F.array_join(F.collect_list(row), ""), F.lit("</tbody></table>")).alias("html"))
    cells = readers.html_tables(pages, "page", "html")
    return cells.select("page", F.col("cells")[0].cast("long").alias("part"), F.col("cells")[1].alias("name"), F.col("cells")[2].alias("size"))


@query("SELECT 'f' || p_partkey % 20 AS parent, sum(length(p_name) + 1)::BIGINT AS size, count(*) AS lines FROM part GROUP BY 1")
def op_s12(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf, "part").select(F.concat(F.lit("f"), (F.col("p_partkey") % 20).cast("string")).alias("folder"), F.col("p_name").alias("value"))
    rows.repartition("folder").write.partitionBy("folder").option("lineSep", "\n").text(path)
    files = readers.read_pages(spark, path, "*.txt")
    return files.groupBy(F.substring_index("parent", "=", -1).alias("parent")).agg(F.sum("size").alias("size"), F.sum(F.size(F.split("content", "\n")) - 1).cast("long").alias("lines"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'broken' WHEN s_suppkey % 3 = 0 THEN 'cached' ELSE 'missing' END AS state, CASE WHEN s_suppkey % 5 > 0 AND s_suppkey % 3 = 0 THEN s_suppkey * 2 END AS k FROM supplier")
def op_s7_i5(spark: SparkSession, sf: str) -> DataFrame:
    """A landing folder of documents: those of the wanted version that parse need no fetch."""
    key = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey")
    body = F.when(key % 5 == 0, "{oops").otherwise(F.concat(F.lit('{"k": '), (key * 2).cast("string"), F.lit("}")))
    landing = s.filter("s_suppkey % 3 = 0 or s_suppkey % 5 = 0").select("s_suppkey", F.when(key % 2 >= 0, 2).alias("version"), body.alias("body"))
    old = s.filter("s_suppkey % 5 > 0").select("s_suppkey", F.lit(1).alias("version"), F.lit('{"k": 0}').alias("body"))
    return readers.read_through(s, landing.unionByName(old), "s_suppkey", "k long", 2).select("s_suppkey", "state", "doc.k")


@query("SELECT o_custkey, o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price FROM orders WHERE o_custkey % 3 > 0 OR o_orderstatus = 'F' OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def op_w4(spark: SparkSession, sf: str) -> DataFrame:
    """Every third customer is reloaded with finished orders at twice the price, as far as there are any."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    again = orders.filter("o_custkey % 3 = 0 and o_orderstatus = 'F'").withColumn("price", F.col("price") * 2)
    return sinks.replace_groups(orders, again, "o_custkey").select("o_custkey", "o_orderkey", "price")


@query("SELECT n_regionkey, CAST(count(*) AS INTEGER) AS count, list(n_name ORDER BY n_nationkey) AS names FROM nation GROUP BY 1")
def op_w8(spark: SparkSession, sf: str) -> DataFrame:
    made = sinks.envelope(table(spark, sf, "nation").select("n_regionkey", "n_nationkey", "n_name"), "now", ["n_nationkey"], "n_regionkey")
    doc = F.from_json("document", "timestamp string, count int, rows array<struct<n_nationkey: long, n_name: string>>")
    return made.select("n_regionkey", doc.alias("d")).select("n_regionkey", "d.count", F.col("d.rows.n_name").alias("names"))


@query(f"""WITH {WIDE_SQL} SELECT entity, round(net_income / nullif(shares, 0), 6) AS eps, CASE WHEN net_income IS NOT NULL AND shares <> 0 THEN 'net_income / shares' END AS eps_formula, round(net_income / nullif(revenue, 0), 6) AS net_margin, CASE WHEN net_income IS NOT NULL AND revenue <> 0 THEN 'net_income / revenue' END AS net_margin_formula,
CASE WHEN equity > 0 THEN round(debt / equity, 6) END AS debt_equity, CASE WHEN equity > 0 AND debt IS NOT NULL THEN 'debt / equity' END AS debt_equity_formula, CASE WHEN debt IS NULL THEN 'debt_equity: no debt' ELSE '' END AS notes FROM wide""")
def op_w10(spark: SparkSession, sf: str) -> DataFrame:
    sheet = ratios.lineage_sheet(wide(spark, sf), "entity", {"eps": ("net_income", "shares", False), "net_margin": ("net_income", "revenue", False), "debt_equity": ("debt", "equity", True)})
    notes = C.joined_notes({"debt_equity: no debt": F.col("debt").isNull()})
    return rounded(sheet.withColumn("notes", notes).select("entity", *[c for n in ("eps", "net_margin", "debt_equity") for c in (n, f"{n}_formula")], "notes"))


@query("""SELECT s_nationkey AS job, count(*) AS done, count(*) FILTER (s_suppkey % 3 = 0) AS failed, CASE WHEN count(*) FILTER (s_suppkey % 3 = 0) = 0 THEN 'ok' WHEN count(*) FILTER (s_suppkey % 3 = 0) < count(*) THEN 'partial' ELSE 'failed' END AS state, max(CASE WHEN s_suppkey % 3 = 0 THEN 'no data for ' || s_suppkey END) AS error FROM supplier GROUP BY 1""")
def op_i4_w14(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows that several batches append, and each job's state from them."""
    path = scratch(spark)
    s = table(spark, sf, "supplier")
    error = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("no data for "), F.col("s_suppkey").cast("string")))
    log = s.select(F.col("s_nationkey").alias("job"), F.col("s_suppkey").alias("item"), error.alias("error"))
    for k in range(2):
        sinks.append_log(log.filter(F.col("item") % 2 == k), path)
    return incremental.job_states(spark.read.parquet(path))


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def op_i3(spark: SparkSession, sf: str) -> DataFrame:
    """A table that a stream of files feeds in two runs, late rows first."""
    root = scratch(spark)
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", F.col("ts").cast("string").alias("ts"))
    for k in (1, 0):
        events.filter(F.col("event_id") % 2 == k).write.mode("append").json(f"{root}/in")
        incremental.run_upserts(spark, f"{root}/in", "user_id long, event_type string, event_id long, value double, ts string", f"{root}/out", ["user_id", "event_type"], ["ts", "event_id"], f"{root}/state")
    return spark.read.parquet(f"{root}/out").select("user_id", "event_type", "event_id", "value")


@query(f"""WITH {FACTS_SQL}, d AS (SELECT DISTINCT filed FROM facts WHERE filed BETWEEN DATE '1995-01-01' AND DATE '1995-12-31') SELECT CAST(year(filed) AS INTEGER) AS y, count(*) AS days FROM d GROUP BY 1""")
def op_i2(spark: SparkSession, sf: str) -> DataFrame:
    days = facts(spark, sf).filter(F.col("filed").between("1995-01-01", "1995-12-31")).select("filed").distinct()
    return days.groupBy(F.year("filed").alias("y")).agg(F.count(F.lit(1)).alias("days"))

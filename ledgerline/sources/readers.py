"""Readers for the shapes that fundamentals data comes in; every schema is explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import table_rows

#: Forms that carry financial statements.
FORMS = ("10-K", "10-Q", "20-F", "40-F", "10-K/A", "10-Q/A", "20-F/A", "40-F/A", "6-K")
_POINT = "struct<start:string,end:string,val:double,fy:int,fp:string,form:string,filed:string,frame:string>"
COMPANY_FACTS = f"map<string,map<string,struct<label:string,units:map<string,array<{_POINT}>>>>>"


# The characters of the Windows code page at 0x80 to 0x9F that have one, and those places.
_WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_PLACES = "".join(chr(c) for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))


def read_csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """Rows of a CSV sheet; blanks are NULL, and so is what is not a number (Spark orders NaN above all numbers)."""
    df = spark.read.schema(schema).options(header=True, encoding="UTF-8", **options).csv(path)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, for late casting."""
    return spark.read.options(header=True, inferSchema=False).csv(path)


def read_sheet(spark: SparkSession, path: str, least_rows: int, most_rows: int, words: list[str], least_columns: int, charset: str = "windows-1252") -> DataFrame:
    """A comparison sheet: its separator is found on the first line; its shape is checked, and a
    sheet of another shape raises ValueError. Columns are c0, c1, ..."""
    windows = charset == "windows-1252"  # Spark reads the subset that is ISO-8859-1; the rest is mapped
    charset = "ISO-8859-1" if windows else charset
    lines = spark.read.option("encoding", charset).text(path)
    head = [r["value"] for r in lines.limit(5).collect()]
    if not head:
        raise ValueError(f"{path}: empty")
    sep = ";" if head[0].count(";") > head[0].count(",") else ","
    widest = max(h.count(sep) + 1 for h in head)
    if widest < least_columns:
        raise ValueError(f"{path}: {widest} columns")
    missing = [w for w in words if not any(w.lower() in h.lower() for h in head)]
    if missing:
        raise ValueError(f"{path}: no {', '.join(missing)} in its head")
    schema = ", ".join(f"c{k} string" for k in range(widest))
    sheet = spark.read.schema(schema).options(sep=sep, encoding=charset, header=False).csv(path)
    n = sheet.count()
    if not least_rows <= n <= most_rows:
        raise ValueError(f"{path}: {n} rows")
    return sheet.select(*[F.translate(c, _PLACES, _WINDOWS).alias(c) for c in sheet.columns]) if windows else sheet


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """{timestamp, precios: {ticker: {...}}} as one row for each ticker."""
    price = "struct<last_price:double,year_high:double,year_low:double,market_cap:double,shares:bigint,currency:string,exchange:string,previous_close:double,fetched_at:string>"
    doc = spark.read.schema(f"timestamp string, precios map<string,{price}>").option("multiLine", True).json(path)
    return doc.select("timestamp", F.explode("precios").alias("ticker", "p")).select("timestamp", "ticker", "p.*")


def read_json_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def company_facts(documents: DataFrame, as_of: str, days: int = 6 * 365, taxonomies: tuple[str, ...] = ("us-gaap", "ifrs-full")) -> DataFrame:
    """Rows (cik, facts as JSON text) as the long fact table; seq is the place in the document."""
    tree = F.from_json("facts", COMPANY_FACTS)
    flat = documents.select("cik", F.explode(tree).alias("taxonomy", "tags")).filter(F.col("taxonomy").isin(*taxonomies))
    flat = flat.select("cik", "taxonomy", F.explode("tags").alias("tag", "body")).select("cik", "taxonomy", "tag", F.explode("body.units").alias("unit", "points"))
    flat = flat.select("cik", "taxonomy", "tag", "unit", F.posexplode("points").alias("seq", "p"))
    end = F.expr("try_to_date(p.end)")
    kept = flat.filter(F.col("p.val").isNotNull() & F.col("p.form").isin(*FORMS) & (end.isNull() | (end >= F.date_sub(F.lit(as_of).cast("date"), days))))
    return kept.select("cik", "taxonomy", "tag", "unit", F.expr("try_to_date(p.start)").alias("start"), end.alias("end"), "p.val", "p.fy", "p.fp", "p.form", F.expr("try_to_date(p.filed)").alias("filed"), F.col("seq").cast("long").alias("seq"))


def columnar_json(documents: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """{fields: [...], data: [[...]]} as rows with the wanted fields as strings."""
    doc = documents.select(F.from_json(column, "fields array<string>, data array<array<string>>").alias("d"))
    rows = doc.select("d.fields", F.explode("d.data").alias("row"))
    return rows.select(*[F.try_element_at("row", F.array_position("fields", F.lit(w)).cast("int")).alias(w) for w in wanted])


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row_no and cells (texts) of every row of the page's tables."""
    return table_rows(pages, key, html).select(key, "row_no", "cells")


def read_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """path, parent, size and content of all files of a folder tree."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -2).alias("parent"), F.col("length").alias("size"), F.decode("content", "UTF-8").alias("content"))


def read_through(wanted: DataFrame, landing: DataFrame, key: str, schema: str, version: int) -> DataFrame:
    """key, state and doc of every wanted row: cached, if the landing rows (key, version, body) hold a document of
    the version that parses; broken, if one that doesn't; else missing. The last two are to be fetched."""
    found = landing.filter(F.col("version") == version).select(key, F.col("body"), F.from_json("body", schema).alias("doc"))
    broken = F.col("doc").isNull() | F.forall(F.array(*[F.col(f"doc.{f.name}").isNull() for f in found.schema["doc"].dataType]), lambda x: x)
    joined = wanted.join(found, key, "left")
    state = F.when(F.col("body").isNull(), "missing").when(broken, "broken").otherwise("cached")
    return joined.select(key, state.alias("state"), F.when(state == "cached", F.col("doc")).alias("doc"))

"""Write modes: upserts and partial updates as plans, and writes that are checked before they count."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Latest wins: incoming rows replace those with their key; among incoming ones the last by `order`."""
    last = [F.desc(c) for c in order or []] + [F.desc(c) for c in incoming.columns if c not in keys]
    fresh = incoming.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*last))).filter("_rn = 1").drop("_rn")
    return existing.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def insert_new(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First wins: incoming rows whose key is not there yet; among them the first by `order`."""
    fresh = incoming.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")
    return existing.unionByName(fresh.join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def update_missing(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Updates rows by key; the columns `keep` change only where they are NULL."""
    other = [c for c in incoming.columns if c not in keys]
    new = incoming.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in other], F.lit(True).alias("_hit"))
    joined = existing.join(new, keys, "left")
    changed = {c: F.coalesce(c, f"_new_{c}") if c in keep else F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in other}
    return joined.withColumns(changed).select(*existing.columns)


def replace_groups(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Reload: all rows of the incoming keys are replaced."""
    return existing.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def union_header(frames: list[DataFrame], first: list[str]) -> DataFrame:
    """All rows under the union of all columns: `first`, then the rest by name; missing ones NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*first, *sorted(c for c in out.columns if c not in first))


def envelope(rows: DataFrame, timestamp: str, order: list[str], group: str) -> DataFrame:
    """One JSON document {timestamp, count, rows} for each group; a group has to fit in one row."""
    packed = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in rows.columns if c not in (*order, group)]))).alias("rows"))
    return packed.select(group, F.to_json(F.struct(F.lit(timestamp).alias("timestamp"), F.size("rows").alias("count"), "rows")).alias("document"))


def envelope_parts(rows: DataFrame, timestamp: str, order: list[str], group: str, most: int = 10_000) -> DataFrame:
    """As envelope, in documents {timestamp, part, parts, count, rows} of at most `most` rows, so that a group may have any
    number: group, part and document."""
    at = W.partitionBy(group).orderBy(*order)
    numbered = rows.withColumns({"_part": F.floor((F.row_number().over(at) - 1) / most).cast("int"), "_all": F.count(F.lit(1)).over(W.partitionBy(group))})
    packed = numbered.groupBy(group, "_part", "_all").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in rows.columns if c not in (*order, group)]))).alias("rows"))
    parts = F.ceil(F.col("_all") / most).cast("int")
    document = F.to_json(F.struct(F.lit(timestamp).alias("timestamp"), F.col("_part").alias("part"), parts.alias("parts"), F.size("rows").alias("count"), "rows"))
    return packed.select(group, F.col("_part").alias("part"), document.alias("document"))


def checked_write(df: DataFrame, path: str, sentinel: str, fmt: str = "parquet", **options) -> int:
    """Writes beside `path`, counting the rows on the way, reads back, compares the counts, asks for a row that
    meets `sentinel`, and only then takes path's place. Returns the number of rows. A table of an
    earlier write is kept as path.old until the new one is in place; if a run dies between the two renames,
    the next one puts it back."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).options(**options).save(staged)
    again = spark.read.schema(df.schema).format(fmt).options(**options).load(staged)
    n, there = seen.get["n"], again.count()
    if n != there or not again.filter(sentinel).limit(1).count():
        raise ValueError(f"{staged}: {there} of {n} rows, or none with {sentinel}")
    fs, target, old = restored(spark, path)
    had = fs.exists(target)
    if had and not fs.rename(target, old) or not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged), target):
        raise OSError(f"{path}: cannot take its place")
    if had:
        fs.delete(old, True)
    return n


def restored(spark: SparkSession, path: str):
    """The file system, path and place of the earlier table; a table that a broken run left there is put back."""
    jvm = spark.sparkContext._jvm
    target, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path.rstrip('/')}.old"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        elif not fs.rename(old, target):
            raise OSError(f"{path}: cannot be restored")
    return fs, target, old


def coverage_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """metric, n, filled, percent, least, most, mean of numeric columns."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "metric", "value")
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"), (F.count("value") * 100.0 / F.count(F.lit(1))).alias("percent"), F.min("value").alias("least"), F.max("value").alias("most"), F.avg("value").alias("mean"))


def recreate(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Drops what is there and writes df."""
    df.write.mode("overwrite").format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Appends rows with a header in every file; missing values are empty."""
    df.write.mode("append").options(header=True, emptyValue="").csv(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Appends log rows (job, item, error) with the time of writing. Batches that write at once don't disturb each other."""
    rows.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)

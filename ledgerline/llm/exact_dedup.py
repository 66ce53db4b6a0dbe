"""Exact dedup by a tree merge of sorted digest runs, in DataFrame functions only.

Every text becomes an entry of its digest, a second digest of another kind and its length. The
entries of one run (a reading partition, or some of them) are combined where they were read, so that
a text costs one entry a run however many copies it has. Then the runs are merged in binomial rounds:
in round k the run r joins the runs that differ from it in the k-th digit (base FAN) only. Runs that
merge share the work by ranges of digests, so a piece (run, range) stays about as large as
one partition was; it is sorted by digest, equal entries stand together, and the best identifier of
them is kept with the sum of their copies. Entries are equal only if both digests and the length
agree, at every level, so what merges is verified by 320 bits of two unrelated functions and the length. After
the last round one run is left, cut in ranges, with one entry for each different text.

The answers go back the same way: to each run's entry first (one a run, not one a copy), then to the rows
of that run, so a text with a third of all rows is spread over all runs.

Defined cases: null text counts as empty; a null id is worse than any other, and of rows with equal id
and text exactly one stays; an empty table gives no rows; columns not asked for are ignored, and so are
carried ones named like one of the results or starting with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import materialize, partitions

#: Runs that merge at once.
FAN = 16
#: Ranges of digests for each run that has merged; more than one, so that partitions even out.
RANGES = 4
#: Names of the results.
MADE = ("keep_id", "group_size", "kept", "text_sha256")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENTRY = ["_digest", "_check", "_length"]


def normalised(text: str) -> Column:
    """Text in which A-Z are lower case; null becomes empty. Texts of ASCII characters only take the faster function."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))


def _merged(runs: DataFrame, k: int, fan: int, n: int, order: list[Column]) -> DataFrame:
    """Round k: every `fan` runs become one; of equal entries the best stays, with the sum of their copies."""
    # the leading 32 bits of the digest, scaled to the ranges that a run of this level is cut in
    place = F.conv(F.hex(F.substring("_digest", 1, 4)), 16, 10).cast("long")
    ranges = min(n, fan**k) * RANGES
    joined = runs.withColumns({"_run": F.floor(F.col("_run") / fan).cast("int"), "_range": F.shiftright(place * ranges, 32).cast("int")})
    same = W.partitionBy("_run", "_range", *_ENTRY)
    found = joined.repartition(n, "_run", "_range").withColumns({"_rn": F.row_number().over(same.orderBy(*order)), "_n": F.sum("_n").over(same)})
    return found.filter("_rn = 1").drop("_rn", "_range")


def exact_dedup(docs: DataFrame, columns: list[str], text: str = "text", id: str = "doc_id", largest: bool = True, fan: int = FAN) -> DataFrame:
    """`columns` of every document, keep_id (the id that stays of its group of equal texts), group_size, kept
    (whether this row stays) and text_sha256 (lowercase hex of the normalised text). The row with the largest
    id of each group stays, or with the smallest. Kept rows alone are the deduplicated table."""
    n = partitions(docs.sparkSession)
    others = [c for c in dict.fromkeys(columns) if c.lower() not in MADE and not c.startswith("_")]
    # the upper bits of the row number are the partition that reads the row
    rows = docs.select(*others, F.col(id).alias("_id"), F.monotonically_increasing_id().alias("_row"), normalised(text).alias("_text"))
    run = F.pmod(F.shiftright("_row", 33), F.lit(n)).cast("int")
    hashed = materialize(rows.select(*others, "_id", "_row", run.alias("_run"), F.unhex(F.sha2("_text", 256)).alias("_digest"), F.xxhash64("_text").alias("_check"), F.octet_length("_text").alias("_length")))
    known = F.col("_id").isNotNull()
    best = F.max(F.struct(known, "_id", "_row")) if largest else F.min(F.struct(~known, "_id", "_row"))
    entries = hashed.groupBy("_run", *_ENTRY).agg(best.alias("_best"), F.count(F.lit(1)).alias("_n"))
    first = materialize(entries.select("_run", *_ENTRY, "_best._id", "_best._row", "_n").sortWithinPartitions("_run", *_ENTRY))
    order = [F.desc_nulls_last("_id"), F.desc("_row")] if largest else [F.asc_nulls_last("_id"), F.asc("_row")]
    runs, k, left = first, 0, n
    while left > 1 or not k:
        k, left = k + 1, -(-left // fan)
        runs = _merged(runs, k, fan, n, order)
    last = runs.select(*_ENTRY, F.col("_id").alias("keep_id"), F.col("_row").alias("_stays"), F.col("_n").alias("group_size"))
    told = first.select("_run", *_ENTRY).join(last, _ENTRY)
    out = hashed.join(told, ["_run", *_ENTRY])
    return out.select(*others, "keep_id", "group_size", (F.col("_row") == F.col("_stays")).alias("kept"), F.lower(F.hex("_digest")).alias("text_sha256"))

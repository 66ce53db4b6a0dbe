"""Names that are alike, whatever the order of their words: a similarity join by q-grams, without comparing all pairs.

The similarity of two names is 2 LCS / (length + length) of their sorted lower-case tokens (the indel ratio),
in percent. At a threshold t each name has at least a known number of grams in common with any partner,
so one of its rarest grams must be shared: those are its prefix, and names meet in a join of prefix grams only. Pairs
that meet are checked for the length of the longest common subsequence by bit-parallel rows.

A gram is two neighbouring characters with the number of its occurrence in the name. A pair with an
LCS of m shares at least 3 m - length - length - 1 grams. Names so short that this bound says nothing meet by single
characters instead, of which any pair shares m.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import sorted_tokens


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: a row of the table is the bits of one number."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """0 to 100; 100 for two empty texts, NULL if one is NULL."""

    @F.pandas_udf("double")
    def run(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            yield pd.Series([None if v is None or w is None else _ratio(v, w) for v, w in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def _grams(text: Column, q: int) -> Column:
    """Grams of q characters with the number of each occurrence, as text."""
    n = F.length(text) - q + 1
    plain = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(q)))).otherwise(F.array().cast("array<string>"))
    return F.transform(plain, lambda g, i: F.concat(g, F.lit("\x00"), F.size(F.filter(F.slice(plain, 1, i + 1), lambda x: x == g)).cast("string")))


def _least_common(n: Column, t: float, q: int) -> Column:
    """How many grams a text of n characters shares with any partner at least (0 or less: maybe none)."""
    if q == 1:
        return F.ceil(n * (t / (2 - t)) - 1e-9)
    return F.ceil(n * ((1.5 * t - 1) * 2 / (2 - t)) - 1e-9) - 1


def _prefixes(names: DataFrame, counts: DataFrame, t: float, q: int) -> DataFrame:
    """_id, _length and _gram: the rarest grams of each name, one of which any partner shares."""
    grams = names.select("_id", F.length("_name").alias("_length"), F.explode(_grams(F.col("_name"), q)).alias("_gram"))
    # a row holds the grams of one name
    known = grams.join(counts, "_gram").groupBy("_id", "_length").agg(F.array_sort(F.collect_list(F.struct("_n", "_gram"))).alias("_g"))
    keep = F.size("_g") - F.greatest(_least_common(F.col("_length"), t, q), F.lit(1)) + 1
    return known.select("_id", "_length", F.explode(F.slice("_g", 1, F.greatest(keep, F.lit(1)).cast("int"))).alias("_x")).select("_id", "_length", F.xxhash64("_x._gram").alias("_gram"))


def candidates(left: DataFrame, right: DataFrame, percent: float) -> DataFrame:
    """Pairs (_name, _other) of distinct texts that may reach the similarity; left and right hold distinct _name. Names meet as
    hashes; different names of one hash only make more candidates."""
    t = percent / 100
    left, right = (x.select("_name", F.xxhash64("_name").alias("_id")) for x in (left, right))
    pairs = None
    for q in (2, 1):
        a, b = left, right
        if q == 1:  # what two characters at a time can't promise: both names are that short
            short = _least_common(F.length("_name"), t, 2) < 1
            a, b = left.filter(short), right.filter(short)
        grams = a.union(b).distinct().select(F.explode(_grams(F.col("_name"), q)).alias("_gram"))
        counts = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
        x = _prefixes(a, counts, t, q)
        y = _prefixes(b, counts, t, q).withColumnsRenamed({"_id": "_other_id", "_length": "_m"})
        met = x.join(y, "_gram").filter(2 * F.least("_length", "_m") >= t * (F.col("_length") + F.col("_m")) - 1e-9).select("_id", "_other_id")
        pairs = met if pairs is None else pairs.union(met)
    empty = F.xxhash64(F.lit(""))
    pairs = pairs.union(left.filter("_name = ''").select("_id", empty)).distinct()
    return pairs.join(left, "_id").join(right.select(F.col("_name").alias("_other"), F.col("_id").alias("_other_id")), "_other_id").select("_name", "_other")


def _scored(left: DataFrame, right: DataFrame, percent: float) -> DataFrame:
    """_name, _other and score of all pairs of distinct texts that are alike."""
    if not 200 / 3 < percent <= 100:
        raise ValueError(f"percent={percent}: over 66.7 and up to 100")
    found = candidates(left.select("_name").dropna().distinct(), right.select(F.col("_other").alias("_name")).dropna().distinct(), percent)
    return found.withColumn("score", indel_ratio("_name", "_other")).filter(F.col("score") >= percent - 1e-9)


def similar_names(left: DataFrame, right: DataFrame, a: str, b: str, percent: float = 85.0) -> DataFrame:
    """Pairs of rows whose names a and b are alike by at least `percent` (over 200 / 3, below which grams promise nothing), with
    the score. Equal names are compared once, however many rows bear them. Column names of both sides differ; NULL names match nothing."""
    x, y = left.withColumn("_name", sorted_tokens(a)), right.withColumn("_other", sorted_tokens(b))
    return x.join(_scored(x, y, percent), "_name").join(y, "_other").drop("_name", "_other")


def best_names(left: DataFrame, right: DataFrame, key: str, a: str, b: str, other: str, percent: float = 85.0) -> DataFrame:
    """Each left row (unique by key) with the most similar right row, the least `other` on ties, or with NULLs. The best is
    found once for each distinct name."""
    x, y = left.withColumn("_name", sorted_tokens(a)), right.select(other, b, sorted_tokens(b).alias("_other"))
    least = y.dropna(subset=["_other"]).groupBy("_other").agg(F.min_by(F.struct(other, b), other).alias("_row"))
    order = F.struct(F.col("score"), -F.col("_row")[other])
    best = _scored(x, y, percent).join(least, "_other").groupBy("_name").agg(F.max_by(F.struct("_row", "score"), order).alias("_best"))
    return x.join(best, "_name", "left").select(*left.columns, F.col("_best._row")[other].alias(other), F.col("_best._row")[b].alias(b), F.col("_best.score").alias("score"))

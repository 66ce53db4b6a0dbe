"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the text's likelihood under byte trigram models, the
declared language (markup or metadata), the address suffix, and a prior for the host. How a
declared language or a suffix speaks for a language, and the hosts' priors, are grouped counts of
what the texts alone say. Priors are smoothed down the hierarchy: a host's counts are added to
those of its domain, which are added to those of all rows. A row's own text is left out of its
host's counts. A text's log likelihood counts as that of EFFECTIVE trigrams at most, as the
trigrams of one text depend on each other.

The trigram models learn from a bounded sample: about TRAIN_ROWS different texts a language, chosen
by a hash, of every language that has labelled rows; a language takes BINS numbers of four bytes
in each worker. Everything else sees all rows and whole texts.

A text is in none of the languages if a background explains it NONE times better (as a log) than
the best of them, and than all of them mixed: each trigram by how often its three letters occur in
all languages together, and by an even share of the bins where that is more. Such a text has no
language, whatever is declared. A close relative of a trained language can still pass for it.

Defined cases: null, empty or letterless text has no likelihood, and the other evidence decides;
if there is none of that either, or the text is in none of the languages, the language is null
and the confidence 0; an unknown or
malformed declaration, suffix or host is no evidence; equal posteriors go to the first language
by name; an empty table gives no rows; columns not asked for are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import materialize
from ledgerline.llm.rolling import text_buffer

TRAIN_ROWS, BINS = 1_000, 1 << 16
EFFECTIVE, NONE = 60, 3.0
#: Rows that a level's counts weigh as much as.
STRENGTH = 8.0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_FOLD[~_LETTER[_FOLD]] = 32


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Bins of the trigrams at each place; those without a letter are -1."""
    x = _FOLD[data].astype(np.int64)
    letter = x != 32
    code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    return np.where(letter[1:-1], (code * 2654435761 >> 13) % BINS, -1)


@dataclass(frozen=True)
class Table:
    """bins: log probability of each bin in each language (BINS x languages); mixed: of each bin in
    all of them together; background: of each byte."""

    bins: np.ndarray
    mixed: np.ndarray
    background: np.ndarray


def _background(data: np.ndarray, background: np.ndarray) -> float:
    """Log likelihood of the text's trigrams in no language in particular."""
    x = _FOLD[data]
    p = background[x]
    return float(np.maximum(p[:-2] + p[1:-1] + p[2:], -math.log(BINS))[x[1:-1] != 32].sum())


def train(rows: DataFrame, text: str = "text", label: str = "lang", train_rows: int = TRAIN_ROWS) -> tuple[list[str], Table]:
    """The languages by name, and their table."""
    named = rows.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    texts = named.groupBy("lang").agg(F.approx_count_distinct("h").alias("texts"))
    # a text is in the sample if its hash is in the part of all hashes that holds train_rows texts
    part = F.least(F.lit(1.0), F.lit(float(train_rows)) / F.greatest(F.lit(1), F.col("texts")))
    below = texts.select("lang", F.ceil(part * (1 << 40)).alias("_below"))
    sample = named.join(F.broadcast(below), "lang").filter(F.pmod("h", F.lit(1 << 40)) < F.col("_below")).select("lang", "text", "h").dropDuplicates(["lang", "h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            total: dict[str, list[np.ndarray]] = {}
            for name, a, b in zip(batch.column("lang").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                bins = _trigrams(data[a:b]) if b - a > 2 else np.zeros(0, np.int64)
                # letters stand behind the bins
                total.setdefault(name, []).append(np.concatenate([bins[bins >= 0], BINS + _FOLD[data[a:b]].astype(np.int64)]))
            for name, found in total.items():
                k, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(n, pa.int64())], ["lang", "bin", "n"])

    counted = sample.drop("h").mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    # a row a language, of BINS + 256 pairs at most
    by_language = materialize(counted.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("pairs")))
    names = sorted(r["lang"] for r in by_language.select("lang").collect())
    table, bytes_ = np.zeros((BINS, len(names)), np.float32), np.zeros(256)
    mixed = np.zeros(BINS)
    place = {x: k for k, x in enumerate(names)}
    for r in by_language.toLocalIterator():
        n = np.zeros(BINS + 256)
        for pair in r["pairs"]:
            n[pair[0]] = pair[1]
        bytes_ += n[BINS:]
        n = n[:BINS] + 0.5
        table[:, place[r["lang"]]] = np.log(n / n.sum())
        mixed += n / n.sum() / len(names)
    bytes_ += 0.5
    return names, Table(table, np.log(np.maximum(mixed, 1e-300)), np.log(bytes_ / bytes_.sum()))


def _likelihoods(rows: DataFrame, columns: list[str], model: Table) -> DataFrame:
    """columns, likelihood (log likelihoods by language; null without a trigram and for texts in none
    of the languages) and _foreign (whether a text is in none of them)."""
    table = rows.sparkSession.sparkContext.broadcast(model)  # BINS numbers a language
    fields = [*(rows.schema[c] for c in columns), T.StructField("_likelihood", T.ArrayType(T.DoubleType())), T.StructField("_foreign", T.BooleanType())]
    schema = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins_, mixed, background = table.value.bins, table.value.mixed, table.value.background
        for batch in batches:
            data, offsets = text_buffer(batch.column("_text"))
            values: list[list[float] | None] = []
            foreign: list[bool] = []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                total, n, none, mix = np.zeros(bins_.shape[1]), 0, 0.0, 0.0
                for c in range(a, b - 2, 1 << 20):  # long texts in parts
                    part = data[c : min(b, c + (1 << 20) + 2)]
                    bins = _trigrams(part)
                    counts = np.bincount(bins[bins >= 0], minlength=1)
                    some = np.flatnonzero(counts)
                    for k in range(0, len(some), 1 << 12):
                        total += counts[some[k : k + (1 << 12)]] @ bins_[some[k : k + (1 << 12)]]
                    mix += float(counts[some] @ mixed[some])
                    none += _background(part, background)
                    n += int(counts.sum())
                foreign.append(n > 0 and (none - max(mix, total.max())) * min(n, EFFECTIVE) / n >= NONE)
                values.append((total * min(n, EFFECTIVE) / n).tolist() if n and not foreign[-1] else None)
            out = pa.table([*(batch.column(c) for c in columns), pa.array(values, pa.list_(pa.float64())), pa.array(foreign, pa.bool_())], names=[f.name for f in fields])
            yield from out.cast(schema).to_batches()

    return rows.select(*columns, "_text").mapInArrow(run, T.StructType(fields))


def _counts(rows: DataFrame, key: str, name: str, n: int) -> DataFrame:
    """For each value of key, the rows by what language their text speaks for (an array)."""
    return _summed(rows.groupBy(key, "_best").agg(F.count(F.lit(1)).cast("double").alias("_n")), key, name, n)


def _summed(counts: DataFrame, key: str, name: str, n: int) -> DataFrame:
    """For each value of key, the counts _n by language (null _best for none) as an array."""
    pairs = counts.groupBy(key, "_best").agg(F.sum("_n").alias("_n")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("_best").isNotNull(), F.struct("_best", "_n")))).alias("_m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.try_element_at("_m", k), F.lit(0.0)))
    return pairs.select(key, filled.alias(name))


def identify(rows: DataFrame, columns: list[str], model: tuple[list[str], np.ndarray], text: Column, declared: Column, host: Column) -> DataFrame:
    """`columns`, lang, confidence (its posterior), text_lang (by the text alone) and declared_lang.
    text, declared and host are expressions over rows; the suffix is the host's last label. A result
    column takes the place of a carried one of its name."""
    names, table = model
    n = len(names)
    columns = [c for c in columns if c not in ("lang", "confidence", "text_lang", "declared_lang")]
    if not n:
        none = F.lit(None).cast("string")
        return rows.select(*columns, none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), none.alias("declared_lang"))
    host = F.lower(host)
    code = F.regexp_extract(F.lower(declared), r"^\s*([a-z]{2,3})(?:[-_][a-z0-9_-]*)?\s*$", 1)
    prepared = rows.withColumns({"_text": F.coalesce(text.cast("string"), F.lit("")), "_declared": F.when(code != "", code), "_host": F.when(host != "", host)})
    found = _likelihoods(prepared, [*columns, "_declared", "_host"], table)
    best = F.when(F.col("_likelihood").isNotNull(), F.array_position("_likelihood", F.array_max("_likelihood")).cast("int") - 1)
    found = materialize(found.withColumn("_best", best))
    zeros = F.array_repeat(F.lit(0.0), n)
    # a row for each host and language
    hosts = materialize(found.filter(F.col("_host").isNotNull()).groupBy("_host", "_best").agg(F.count(F.lit(1)).cast("double").alias("_n")))
    hosts = hosts.withColumn("_domain", F.regexp_extract("_host", r"([^.]+\.[^.]+|[^.]+)\.?$", 1)).withColumn("_suffix", F.substring_index("_host", ".", -1))
    levels = _summed(hosts, "_host", "_by_host", n).join(hosts.select("_host", "_domain", "_suffix").distinct(), "_host")
    hosts = levels.join(_summed(hosts, "_domain", "_by_domain", n), "_domain").join(_summed(hosts, "_suffix", "_by_suffix", n), "_suffix").select("_host", "_by_host", "_by_domain", "_by_suffix")
    # at most 26**2 + 26**3 declarations
    declarations = F.broadcast(_counts(found.filter(F.col("_declared").isNotNull()), "_declared", "_by_declared", n))
    every = [0.0] * n
    for r in found.filter(F.col("_best").isNotNull()).groupBy("_best").count().collect():  # a row a language
        every[r["_best"]] = float(r["count"])
    total = sum(every)
    numbers = lambda x: F.from_json(F.lit(json.dumps(x)), "array<double>")
    joined = found.join(declarations, "_declared", "left").join(hosts, "_host", "left")

    def without_own(counts: str) -> Column:
        """A level's counts without the row's own text."""
        return F.transform(F.coalesce(F.col(counts), zeros), lambda x, k: F.greatest(x - F.when(F.col("_best") == k, 1.0).otherwise(0.0), F.lit(0.0)))

    def added(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def level(counts: str, above: str) -> Column:
        """A level's shares, smoothed by the level above."""
        return F.zip_with(counts, above, lambda x, p: (x + STRENGTH * p) / (F.col(f"{counts}_rows") + STRENGTH))

    def speaks(counts: str) -> Column:
        """Log likelihood of a declaration or suffix in each language."""
        seen = F.zip_with(without_own(counts), "_every", lambda x, e: F.log((x + 0.5) / (e + 1.0)))
        return F.when(F.col(counts).isNotNull(), seen).otherwise(zeros)

    # every level is a column of its own, so that no expression is written out more than once
    joined = joined.withColumns({"_every": numbers(every), "_p0": numbers([(x + 1) / (total + n) for x in every])})
    joined = joined.withColumns({"_of_domain": without_own("_by_domain"), "_of_host": without_own("_by_host")})
    joined = joined.withColumns({f"{c}_rows": added(F.col(c)) for c in ("_of_domain", "_of_host")})
    joined = joined.withColumn("_p1", level("_of_domain", "_p0")).withColumn("_p2", level("_of_host", "_p1"))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = plus(plus(F.coalesce("_likelihood", zeros), F.transform("_p2", lambda x: F.log(x))), plus(speaks("_by_declared"), speaks("_by_suffix")))
    joined = joined.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    some = ~F.col("_foreign") & (F.col("_likelihood").isNotNull() | F.col("_by_declared").isNotNull() | F.col("_by_host").isNotNull())
    named = F.from_json(F.lit(json.dumps(names)), "array<string>")
    confidence = 1 / F.aggregate(F.transform("_logs", lambda x: F.exp(x - F.col("_top"))), F.lit(0.0), lambda a, b: a + b)
    chosen = F.element_at(named, F.array_position("_logs", F.col("_top")).cast("int"))
    return joined.select(*columns, F.when(some, chosen).alias("lang"), F.when(some, confidence).otherwise(0.0).alias("confidence"), F.when(F.col("_best").isNotNull(), F.element_at(named, F.col("_best") + 1)).alias("text_lang"), F.col("_declared").alias("declared_lang"))


def identify_pages(pages: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """page_id, url and the languages of each page (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(</\1\s*>|$)|<!--.*?(-->|$)|<[^>]*(>|$)|&#?\w+;", " ")
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z0-9_-]+)", 1)
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return identify(pages, ["page_id", "url"], model, text, declared, host)

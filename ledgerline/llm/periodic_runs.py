"""Periodic runs of words, found by probing a harmonic grid.

A run is a stretch of consecutive words with smallest period q, of at least max(24, 3 q) words, that
no neighbouring word extends with this period. For every period p the words at the grid points jp and (j+1)p
are compared, n/p tests each, n log n for all periods. A run of period p holds at least three periods, hence the
words of two grid steps in a row and all between them, so only points survive at which two steps in a row
and the word half a step further agree too. A survivor is extended to both sides by comparing chunks of growing size
of the array with itself p places on. Grid steps within a run that is already found (of the same
period, or of one that divides it: there the stretch would have that smaller period) are skipped,
so a text of one word takes one extension, not one for each period.

Grids of many periods are tested at once, by array operations of bounded size. Words are compared as
numbers that stand for their exact bytes within one batch, so no two different words meet. A document is one task's
work, whole; no row is shuffled.

Defined cases: null and empty text has no words, no runs and an empty collapsed text; repeated rows are
documents of their own; an empty table gives no rows; columns not asked for are ignored, and so are
carried ones named like one of the results. plant leaves a row without an id as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.rolling import Words, slices, text_buffer

#: Least words of a run, and least periods.
LEAST, PERIODS = 24, 3
#: Grid steps tested at a time, and bytes of text laid out at a time.
STEPS, PART = 1 << 20, 4 << 20
_FIRST = 32
#: Names of the results.
MADE = ("n_words", "runs", "collapsed")
_RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _agree(words: np.ndarray, at: int, p: int, step: int) -> int:
    """How many places from `at` on (step 1) or before it (step -1) hold the same word as p places on."""
    n, size = 0, _FIRST
    while True:
        if step > 0:
            a, b = at + n, min(at + n + size, len(words) - p)
        else:
            a, b = max(at - n - size, 0), at - n
        if a >= b:
            return n
        differ = np.flatnonzero(words[a:b] != words[a + p : b + p])
        if len(differ):
            return n + int(differ[0] if step > 0 else b - a - 1 - differ[-1])
        n, size = n + b - a, size * 2


class _Found:
    """The runs of one period, in the order of their starts; runs of one period overlap by less than a period."""

    def __init__(self):
        self.start: list[int] = []
        self.end: list[int] = []

    def holds(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of the spans low to high (inclusive) lie within one of the runs."""
        start, end = np.array(self.start), np.array(self.end)
        k = np.searchsorted(start, low, side="right") - 1
        there = k >= 0
        k = np.maximum(k, 0)
        inside = there & (end[k] > high)
        before = np.maximum(k - 1, 0)  # the run before may reach further into the overlap
        return inside | there & (k > 0) & (end[before] > high)


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of numbers, by start, then period."""
    n = len(words)
    found: dict[int, _Found] = {}
    p = 1
    most = n // PERIODS if n >= LEAST else 0
    while p <= most:
        # as many periods as STEPS allows
        last = p
        total = (n - 1) // p
        while last < most and total + (n - 1) // (last + 1) <= STEPS:
            last += 1
            total += (n - 1) // last
        periods = np.arange(p, last + 1)
        counts = (n - 1) // periods  # of grid steps j: (j + 1) p < n
        of = np.repeat(periods, counts)
        low = (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)) * of
        same = words[low] == words[low + of]
        # two steps in a row, and half a step further
        twice = np.flatnonzero(same[:-1] & same[1:] & (of[:-1] == of[1:]))
        half = low[twice] + of[twice] // 2
        twice = twice[words[half] == words[half + of[twice]]]
        low, of = low[twice], of[twice]
        for a, b in _stretches(of):
            _extend(words, int(of[a]), low[a:b], found)
        p = last + 1
    runs = [(s, e - s, q) for q, f in found.items() for s, e in zip(f.start, f.end, strict=True)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _stretches(x: np.ndarray) -> list[tuple[int, int]]:
    """First and last place (exclusive) of each stretch of equal numbers."""
    if not len(x):
        return []
    edges = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def _extend(words: np.ndarray, p: int, low: np.ndarray, found: dict[int, _Found]) -> None:
    """Adds the runs of smallest period p at the grid points low, in ascending order."""
    for q in [q for q in found if p % q == 0]:
        low = low[~found[q].holds(low, low + p)]
        if not len(low):
            return
    at = 0
    while at < len(low):
        x = int(low[at])
        end = x + _agree(words, x, p, 1)  # places x to end - 1 hold the word of p places on
        start = x - _agree(words, x, p, -1)
        if end - start + p >= max(LEAST, PERIODS * p) and not any(p % q == 0 and np.array_equal(words[start : start + p], words[start + q : start + q + p]) for q in found if q < p):
            f = found.setdefault(p, _Found())
            f.start.append(start)
            f.end.append(end + p)
        at = int(np.searchsorted(low, end, side="left"))
        at = max(at, int(np.searchsorted(low, x, side="right")))


def plant(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """docs, in which the words of about a tenth of the texts repeat from some word on: with h the crc32 of the id in decimal and g = h / 10,
    if 10 divides h, each word i from a = g % n on becomes word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8). Such a text's words are joined by one space."""
    h = F.crc32(F.col(id).cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    g, n = F.floor(h / 10).cast("long"), F.size("_words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    held = docs.withColumn("_words", words).withColumns({"_a": F.when(n > 0, a), "_p": F.when(n > 0, p)})

    def moved(i: Column) -> Column:
        return F.element_at("_words", (1 + F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))).cast("int"))

    made = F.array_join(F.transform(F.sequence(F.lit(0), F.size("_words") - 1), moved), " ")
    return held.withColumn(text, F.when(F.col("_words").isNotNull() & (F.size("_words") > 0), made).otherwise(F.col(text))).drop("_words", "_a", "_p")


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows of about PART bytes of text."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    first = 0
    while first < len(ends):
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + PART, side="right")))
        yield first, last
        first = last


def _joined(words: Words, stay: np.ndarray) -> list[bytes]:
    """For each text, the words that stay, joined by one space."""
    kept = np.flatnonzero(stay)
    lengths = words.end[kept] - words.start[kept] + 1
    ends = np.cumsum(lengths)
    begin = ends - lengths
    out = words.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.start[kept] - 1 - begin, lengths)]
    out[begin] = 0x20
    last = np.concatenate([[0], ends])[np.searchsorted(kept, words.first)]
    return [out[a + 1 : b].tobytes() if b > a else b"" for a, b in zip(last[:-1], last[1:], strict=True)]


def periodic_runs(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """`columns` of each document, n_words, runs (start, length, period; by start, then period) and collapsed:
    the words left when of each run only the first period stays, joined by one space."""
    others = [c for c in dict.fromkeys(columns) if c != text and c.lower() not in MADE]
    fields = [*(docs.schema[c] for c in others), T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS), T.StructField("collapsed", T.StringType())]
    schema = to_arrow_schema(T.StructType(fields))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(len(others))
            for a, b in _parts(whole):
                part = batch.slice(a, b - a)
                words = Words(*text_buffer(pc.fill_null(part.column(len(others)), "")))
                coded = slices(words.data, words.start, words.end).dictionary_encode().indices.to_numpy()
                stay = np.ones(len(coded), bool)
                runs = []
                for x, y in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    of = find_runs(coded[x:y])
                    for s, length, q in of:
                        stay[x + s + q : x + s + length] = False
                    runs.append(of)
                lists = [[{"start": s, "length": length, "period": q} for s, length, q in of] for of in runs]
                made = [pa.array(np.diff(words.first)), pa.array(lists, schema.field("runs").type), pa.array(_joined(words, stay), pa.binary()).cast(pa.string())]
                out = pa.table([*(part.column(k) for k in range(len(others))), *made], names=[f.name for f in fields])
                yield from out.cast(schema).to_batches()

    return docs.select(*others, F.col(text).cast("string").alias("_text")).mapInArrow(search, T.StructType(fields))


def digest(found: DataFrame) -> DataFrame:
    """n_runs, the run of greatest exponent (the first by start, then period, on ties), and digests of all runs and of the collapsed text."""
    # lengths over periods are compared by cross products, exactly
    better = lambda x, y: F.when(x.isNull() | (y["length"] * x["period"] > x["length"] * y["period"]), y).otherwise(x)
    top = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    made = found.withColumn("_top", top)
    return made.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_top.start", "_top.length", "_top.period", F.floor(F.lit(1000) * F.col("_top.length") / F.col("_top.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

"""Ranked lexical search: an inverted index in segments, searched by Block-Max WAND.

Index. Documents are dealt in segments of bounded text; a segment is a row of a table. Its documents
are numbered by length, shortest first, so neighbours have like impacts. A term's postings (place,
occurrences) are cut in blocks of POSTINGS, compressed as differences in bytes of seven bits. The
directory holds for each block its last place, its place in the bytes, and its maximum impact. As
impacts depend on counts of the whole corpus, the maximum is stored as the pairs (occurrences, document) that no
other pair of the block beats on both; the largest impact among them is the block's exact maximum under any counts.
All terms of all documents are indexed, and every row.

Search. Queries are taken in blocks of bounded text and shipped to the segments. One pass over the directories counts
in how many documents each wanted term is; N, L and these counts fix weights. For a query and
a segment the list maxima are summed first: below the threshold, the whole segment is skipped. Then the block pointers of all
its terms move over the places of the segment in steps of CELL places (shallow moves: the directory alone
is read), which gives a bound for each step by the block maxima; steps below the threshold are skipped before any of
their blocks is decompressed. The other steps are taken best bound first: their blocks
are decompressed, scores are exact, and the threshold (the k-th best score so far) rises, which skips
more. All of this is done by array operations. The threshold is kept from segment to segment of a task, and
a pilot round over a sixteenth of the segments sets it for all others; skipping asks for a bound
that is strictly below, so ties are whole.

Defined cases: null text has no terms and does not count in N; a null doc_id sorts last among ties;
repeated rows are documents (or items) of their own; an item without known terms has no rows; empty tables
give no rows; other columns are ignored, so names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerline.llm.common import NO_ID, column, materialize, pack_columns, record, text_blocks, unpack
from ledgerline.llm.rolling import _LOWER, slices, text_buffer

#: Bytes of text and rows of a segment at most (one longer document is a segment of its own).
SEGMENT_BYTES, SEGMENT_ROWS = 8 << 20, 1 << 20
#: Postings of a block; places of a step of the block pointers; steps that are opened at once at first.
POSTINGS, CELL, OPENED = 64, 64, 4
#: Bytes of text of the queries that are shipped at once.
QUERY_BYTES = 1 << 20
#: One segment in so many sets the thresholds for the others.
PILOT = 16
K = 10

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

INDEX = "segment long, n_docs long, n_terms long, documents binary, terms binary, blocks binary, bytes binary"
_INDEX = pa.schema([("segment", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), *((c, pa.binary()) for c in ("documents", "terms", "blocks", "bytes"))])
_HIT = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Which text each term stands in, and the terms: the longest stretches of letters, digits and bytes
    from 0x80 up, with A-Z in lower case."""
    data, offsets = text_buffer(texts)
    solid = _TERM[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before[edges], after[edges - 1] = False, False
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return np.searchsorted(offsets, start, side="right") - 1, slices(_LOWER[data], start, end)


def pack_numbers(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in bytes of seven bits (the eighth tells that more follow), and where each starts (one more)."""
    n = np.ones(len(x), np.int64)
    for k in (7, 14, 21, 28):
        n += x >> k > 0
    starts = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(starts[-1], np.uint8)
    for k in range(5):
        some = np.flatnonzero(n > k)
        out[starts[some] + k] = (x[some] >> 7 * k & 0x7F) | np.where(n[some] > k + 1, 0x80, 0)
    return out, starts


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 0x80)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    out = (data[starts] & 0x7F).astype(np.int64)
    for k in range(1, int((ends - starts).max(initial=0)) + 1):
        some = np.flatnonzero(ends - starts >= k)
        out[some] |= (data[starts[some] + k] & 0x7F).astype(np.int64) << 7 * k
    return out


def _segment(ids: pa.Array, texts: pa.Array) -> list[list]:
    """The columns n_docs, n_terms, documents, terms, blocks and bytes of one segment."""
    text, found = terms_of(texts)
    coded = found.dictionary_encode()
    n_docs = len(ids)
    size = np.bincount(text, minlength=n_docs)  # terms of each document
    order = np.argsort(size, kind="stable")
    place = np.empty(n_docs, np.int64)
    place[order] = np.arange(n_docs)
    # occurrences of each term in each document, by term, then place
    at, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n_docs + place[text], return_counts=True) if len(text) else (np.zeros(0, np.int64),) * 2
    term, doc = at // max(1, n_docs), at % max(1, n_docs)
    n_terms = len(coded.dictionary)
    df = np.bincount(term, minlength=n_terms)
    first = np.cumsum(df) - df  # of each term's postings
    blocks_of = -(-df // POSTINGS)
    begin = np.repeat(first, blocks_of) + (np.arange(blocks_of.sum()) - np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of)) * POSTINGS
    end = np.append(begin, len(at))[1:]
    block = np.repeat(np.arange(len(begin)), end - begin)
    delta = np.diff(doc, prepend=0)
    delta[first] = doc[first] + 1  # a term's first block counts from -1
    numbers = np.empty(2 * len(at), np.int64)
    numbers[::2], numbers[1::2] = delta, tf
    data, starts = pack_numbers(numbers)
    # what no pair of the block beats: in order of length, those with more occurrences than all before
    high = np.maximum.accumulate(block * (int(tf.max(initial=0)) + 1) + tf) if len(at) else at
    best = np.ones(len(at), bool)
    best[1:] = (block[1:] != block[:-1]) | (high[1:] > high[:-1])
    pairs = np.bincount(block[best], minlength=len(begin))
    documents = pack_columns(doc_id=ids.take(pa.array(order)), size=size[order].astype(np.int32))
    terms = pack_columns(term=coded.dictionary, df=df.astype(np.int32))
    blocks = pack_columns(last=doc[end - 1].astype(np.int32), size=np.diff(np.append(starts[2 * begin], starts[-1])).astype(np.int32), pairs=pairs.astype(np.int32)) + b"|pairs|" + pack_columns(tf=tf[best].astype(np.int32), doc=doc[best].astype(np.int32))
    return [[int((size > 0).sum())], [int(size.sum())], [documents], [terms], [blocks], [data.tobytes()]]


def build_index(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The index of all documents: one row a segment, a table in the shared folder."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []
        size = rows = 0

        def row() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids, texts = (c.chunk(0) for c in whole.columns)
            return record(_INDEX, [segment], *_segment(ids, texts))

        for batch in batches:
            ends, first = np.cumsum(np.asarray(pc.binary_length(batch.column(1))).astype(np.int64)), 0
            while first < batch.num_rows:
                base = int(ends[first - 1]) if first else 0
                last = max(first if held else first + 1, int(np.searchsorted(ends, base + SEGMENT_BYTES - size, side="right")))
                last = min(last, first + SEGMENT_ROWS - rows)
                if last > first:
                    held.append(batch.slice(first, last - first))
                    size, rows = size + int(ends[last - 1]) - base, rows + last - first
                if last < batch.num_rows:
                    yield row()
                    segment += 1
                    held, size, rows = [], 0, 0
                first = last
        if held:
            yield row()

    picked = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return materialize(picked.mapInArrow(segments, INDEX), packed=True)


def _where(terms: pa.Array, wanted: pa.Array) -> np.ndarray:
    """The place of each wanted term among a segment's terms, or -1."""
    return np.asarray(pc.fill_null(pc.index_in(wanted, value_set=terms), -1)).astype(np.int64)


class _Segment:
    """A segment under the counts of the corpus: directory, bounds, and blocks that are decompressed when asked for."""

    def __init__(self, row: dict, terms: pa.Array, weights: np.ndarray, n: int, total: int):
        self.row = row
        directory = unpack(row["terms"])
        at = _where(directory.column("term").combine_chunks(), terms)
        self.term = np.full(len(terms), -1)  # place of each wanted term among those that the segment has
        there = np.flatnonzero(at >= 0)
        self.term[there] = np.arange(len(there))
        self.weight = weights[there]
        df = column(directory, "df").astype(np.int64)
        counts = -(-df // POSTINGS)
        ahead = np.concatenate([[0], np.cumsum(counts)])
        docs = unpack(row["documents"])
        self.ids, sizes = docs.column("doc_id").combine_chunks(), column(docs, "size")
        self.n_docs = len(sizes)
        self.norm = _norms(sizes, n, total)
        # blocks of the wanted terms
        self.block_term = np.repeat(np.arange(len(there)), counts[at[there]])
        self.first = np.concatenate([[0], np.cumsum(counts[at[there]])])
        b = np.repeat(ahead[at[there]], counts[at[there]]) + np.arange(self.first[-1]) - np.repeat(self.first[:-1], counts[at[there]])
        blocks, pairs = (unpack(x) for x in row["blocks"].split(b"|pairs|", 1))
        last, size, n_pairs = (column(blocks, c).astype(np.int64) for c in ("last", "size", "pairs"))
        place = np.cumsum(size) - size
        self.last, self.size, self.place = last[b], size[b], place[b]
        self.before = np.where(b == ahead[at[there]][self.block_term], -1, last[b - 1])
        # maximum impacts
        of = np.cumsum(n_pairs) - n_pairs
        p = np.repeat(of[b], n_pairs[b]) + np.arange(n_pairs[b].sum()) - np.repeat(np.cumsum(n_pairs[b]) - n_pairs[b], n_pairs[b])
        impact = self.impacts(column(pairs, "tf")[p].astype(np.int64), column(pairs, "doc")[p])
        self.most = np.maximum.reduceat(impact, np.cumsum(n_pairs[b]) - n_pairs[b]) * self.weight[self.block_term] if len(b) else np.zeros(0, np.int64)
        self.list_most = np.maximum.reduceat(self.most, self.first[:-1]) if len(b) else np.zeros(0, np.int64)
        # bounds of all steps: the block pointers of all terms move over the places
        self.cells = -(-self.n_docs // CELL)
        low, high = (self.before + 1) // CELL, self.last // CELL
        span = high - low + 1
        cell = np.repeat(low, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        self.low, self.high = low, high
        self.bound = np.zeros((len(there), self.cells), np.int64)
        np.maximum.at(self.bound, (np.repeat(self.block_term, span), cell), np.repeat(self.most, span))
        self.data = None
        self.opened = np.zeros(len(b), bool)
        self.docs = np.zeros((len(b), POSTINGS), np.int32)
        self.scores = np.zeros((len(b), POSTINGS), np.int64)

    def impacts(self, tf: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 8 * self.norm[doc])

    def open(self, b: np.ndarray) -> None:
        """Decompresses the blocks b that are not yet."""
        b = b[~self.opened[b]]
        if not len(b):
            return
        if self.data is None:
            self.data = np.frombuffer(self.row["bytes"], np.uint8)
        size = self.size[b]
        ends = np.cumsum(size)
        data = self.data[np.repeat(self.place[b] - (ends - size), size) + np.arange(ends[-1])]
        numbers = unpack_numbers(data)
        n = np.diff(np.searchsorted(np.flatnonzero(data < 0x80), ends), prepend=0) // 2  # a block ends where its bytes end
        which = np.repeat(np.arange(len(b)), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        run = np.cumsum(numbers[::2])
        doc = run - np.repeat(np.concatenate([[0], run[np.cumsum(n)[:-1] - 1]]), n) + self.before[b][which]
        self.docs[b[which], inside] = doc
        self.scores[b[which], inside] = self.impacts(numbers[1::2], doc) * self.weight[self.block_term[b[which]]]
        self.opened[b] = True

    def search(self, terms: np.ndarray, times: np.ndarray, best: list[tuple[int, int]], k: int, floor: int) -> list[tuple[int, int]]:
        """The k best (-score, doc_id) of what was best so far and of this segment; those below floor don't matter."""
        at = self.term[terms]
        terms, times = at[at >= 0], times[at >= 0]
        threshold = max(floor, -best[-1][0] if len(best) == k else 0, 1)
        if not len(terms) or int((self.list_most[terms] * times).sum()) < threshold:
            return best
        bound = times @ self.bound[terms]
        steps = np.flatnonzero(bound >= threshold)
        steps = steps[np.argsort(-bound[steps], kind="stable")]
        blocks = np.concatenate([np.arange(self.first[t], self.first[t + 1]) for t in terms])
        often = np.repeat(times, self.first[terms + 1] - self.first[terms])
        at, size = 0, OPENED
        while at < len(steps) and bound[steps[at]] >= threshold:
            some = np.zeros(self.cells + 1, np.int64)
            some[1 + steps[at : at + size]] = 1
            before = np.cumsum(some)
            touched = before[self.high[blocks] + 1] > before[self.low[blocks]]
            b, times_b = blocks[touched], often[touched]
            self.open(b)
            total = np.zeros(self.n_docs, np.int64)
            np.add.at(total, self.docs[b].ravel(), (self.scores[b] * times_b[:, None]).ravel())
            total[some[1:][np.arange(self.n_docs) // CELL] == 0] = 0
            hits = np.flatnonzero(total >= threshold)
            if len(hits) > k:
                hits = hits[total[hits] >= np.partition(total[hits], -k)[-k]]
            fresh = [(-int(s), NO_ID if i is None else i) for s, i in zip(total[hits], self.ids.take(pa.array(hits)).to_pylist(), strict=True)]
            best = sorted(best + fresh)[:k]
            threshold = max(threshold, -best[-1][0] if len(best) == k else 0)
            at, size = at + size, size * 2
        return best


def _norms(sizes: np.ndarray, n: int, total: int) -> np.ndarray:
    """Length norms m of documents by their number of terms."""
    if not total or 75 * int(sizes.max(initial=0)) * n < 1 << 62:
        return 25 + 75 * sizes.astype(np.int64) * n // max(1, total)
    return np.array([25 + 75 * int(x) * n // total for x in sizes], np.int64)  # beyond 64 bits on the way


class _Queries:
    """A block of queries: their distinct terms, and each query's terms with their occurrences."""

    def __init__(self, documents: pa.Table, block: int):
        text, found = terms_of(documents.column("text").combine_chunks())
        coded = found.dictionary_encode()
        self.terms = coded.dictionary
        each: list[list[int]] = [[] for _ in range(documents.num_rows)]
        for q, t in zip(text.tolist(), coded.indices.to_pylist(), strict=True):
            each[q].append(t)
        self.items = documents.column("item_id").to_pylist()
        self.key = [block << 16 | k for k in range(len(each))]
        counted = [Counter(x) for x in each]
        self.each = [(np.fromiter(c, np.int64, len(c)), np.fromiter(c.values(), np.int64, len(c))) for c in counted]


def _document_counts(index: DataFrame, terms: pa.Array) -> np.ndarray:
    """In how many documents each of a bounded set of terms is; reads the directories of terms only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for x in batch.column(0):
                directory = unpack(x.as_py())
                at = _where(directory.column("term").combine_chunks(), terms)
                total[at >= 0] += column(directory, "df")[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(len(terms), np.int64)
    for r in index.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row for each term of the block of queries at most
        out[r["term"]] = r["df"]
    return out


def _hits(index: DataFrame, queries: _Queries, weights: np.ndarray, n: int, total: int, k: int, floors: dict[int, int]) -> DataFrame:
    """The k best of each task for each query, of documents that may be among the k best of all."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries.each]
        for batch in batches:
            for row in batch.to_pylist():
                segment = _Segment(row, queries.terms, weights, n, total)
                for q, (terms, times) in enumerate(queries.each):
                    best[q] = segment.search(terms, times, best[q], k, floors.get(queries.key[q], 0))
        rows = [(queries.key[q], i, -s) for q, found in enumerate(best) for s, i in found]
        yield record(_HIT, *([r[c] for r in rows] for c in range(3)))

    return index.select("documents", "terms", "blocks", "bytes").mapInArrow(search, "query long, doc_id long, score long")


def _first(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, text: str = "text", id: str = "item_id", k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0, ties by ascending doc_id."""
    spark: SparkSession = index.sparkSession
    counts = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, total = (int(x or 0) for x in counts)
    item_type = items.schema[id].dataType
    fields = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    blocks = text_blocks(items.select(F.col(id).alias("item_id"), F.col(text).alias("text")), ["item_id", "text"], "text", QUERY_BYTES)
    out = []
    for (block,) in blocks.select("block").collect() if total else ():  # a number for each MB of queries
        payload = blocks.filter(F.col("block") == block).first()["payload"]
        queries = _Queries(unpack(payload), block)
        df = _document_counts(index, queries.terms)
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        weights[df == 0] = 0
        pilot = F.pmod(F.xxhash64("segment"), F.lit(PILOT)) == 0
        early = materialize(_first(_hits(index.filter(pilot), queries, weights, n, total, k, {}), k))
        floors = {r["query"]: r["score"] for r in early.filter(F.col("rank") == k).select("query", "score").collect()}  # a number for each query of the block
        late = _hits(index.filter(~pilot), queries, weights, n, total, k, floors)
        ranked = _first(early.drop("rank").unionByName(late), k)
        names = spark.createDataFrame(list(zip(queries.key, queries.items, strict=True)), T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", item_type)]))
        doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
        out.append(ranked.join(names, "query").select("item_id", "rank", doc.alias("doc_id"), "score"))
    if not out:
        return spark.createDataFrame([], fields)
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found


def ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(build_index(docs), items)

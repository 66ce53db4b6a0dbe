"""Suffix-array dedup: bytes covered by a string of fixed length that also starts earlier.

The collection of all documents is reduced, without loss, to what can repeat. Each window of
`length` bytes has an anchor: its substring of GRAM bytes with the least key (the leftmost
one). Equal windows have equal anchors at the same place, so an anchor that occurs once
excludes its windows. What remains are contexts: an anchor with all bytes of the windows that
have it. All contexts of one anchor, equal or not, go through a column-wise multi-document
construction: they are aligned at their anchors, and each round inserts the next symbol to the
left of every context at once. The symbols in front of the sorted suffixes are the collection's
Burrows-Wheeler transform at that column; sorting them stably gives the next column's order, and
common prefixes follow from those before. Suffixes in one column with a common prefix of `length`
are equal windows; all but the one of least (document, start) go.

The construction's state (transform, order and common prefixes of one column) is an array in a task that
owns a bounded batch of anchors, where the published method keeps sequential files; the batches
are Spark's partitions. A block sends the different contexts that it has once each, so copies in one
block cost one context. An anchor that the blocks have over HOT_CONTEXTS contexts of (hot) is not
gathered: its windows are compared by their keys of 128 bits, each in the task that owns it.

Defined cases: null and empty text, or text shorter than the window, loses nothing; repeated
rows (also with one doc_id) are documents of their own, in some order, so all but one lose their
windows; rows without an id come after all others; an empty table gives no rows; columns not asked
for are ignored, and so are those named like one of the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import NO_ID, NOTE, ask, bits, column, each_block, flags, owners, pack_columns, shares, text_blocks, total_bytes, unpack, with_replies
from ledgerline.llm.rolling import Bytes, covered, distinct_keys, mix, slices, text_buffer

LENGTH = 100
#: Bytes of an anchor.
GRAM = 32
#: Contexts of one anchor that one task compares.
HOT_CONTEXTS = 20_000
#: Contexts in one column-wise construction; one anchor's contexts stay together.
BATCH = 20_000
#: Names of the results.
MADE = ("kept", "n_bytes", "n_removed", "n_spans")
_LOW = np.uint64(0xFFFFFFFF)
#: What is known of an anchor.
UNIQUE, REPEATED, HOT = 0, 1, 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each `width` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


class Anchors:
    """The anchors of a block: place of each, and the first and last window that have it."""

    def __init__(self, documents: pa.Table, id_col: str, text: str, length: int):
        self.data, self.offsets = text_buffer(documents.column(text))
        self.doc_ids = column(documents, id_col)
        self.keys = Bytes(self.data)
        grams = self.keys.windows(GRAM)
        n = len(grams)
        least = sliding_min((grams & ~_LOW) | np.arange(n, dtype=np.uint64), length - GRAM + 1)
        usable = np.repeat(self.offsets[1:] - length, np.diff(self.offsets))[: len(least)] >= np.arange(len(least))
        window = np.flatnonzero(usable)
        place = (least[window] & _LOW).astype(np.int64)
        text_of = np.searchsorted(self.offsets, window, side="right") - 1
        new = np.ones(len(window), bool)
        new[1:] = (place[1:] != place[:-1]) | (text_of[1:] != text_of[:-1])
        at = np.flatnonzero(new)
        self.place, self.first = place[at], window[at]
        self.last = window[np.append(at[1:], len(window)) - 1] if len(at) else window
        self.hash = mix(grams[self.place])  # anchors have low keys; owners hold even ranges
        self.doc = self.doc_ids[text_of[at]]
        self.start = self.first - self.offsets[text_of[at]]
        self.length = length

    def contexts(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Of the anchors `some`: one for each different context (the earliest, ascending by anchor),
        which of those contexts each anchor has, and their bytes."""
        low, high = self.first[some], self.last[some] + self.length
        a, b = (self.keys.spans(low, high, k) for k in (0, 1))
        order = np.lexsort((self.start[some], self.doc[some], b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        lead, code = order[new], np.empty(len(order), np.int64)
        code[order] = np.cumsum(new) - 1
        by = np.lexsort((lead, self.hash[some][lead]))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        lead = lead[by]
        return some[lead], place[code], slices(self.data, low[lead], high[lead])


def earlier_windows(symbols: np.ndarray, rank: np.ndarray, length: int, columns: int) -> np.ndarray:
    """symbols: contexts aligned by column, -1 where a context has none. Returns, for each context
    and each of the first `columns` columns, whether a context of lower rank has the same `length`
    symbols from that column on.

    Column-wise: from the right, each round puts one more symbol in front of every suffix. Sorting
    the suffixes by the new symbol, stably, keeps them in order (this maps the transform's last column
    to its first); two neighbours with the same new symbol share one symbol more than the least common
    prefix between their old places."""
    n, width = symbols.shape
    order, common = np.arange(n), np.zeros(n, np.uint8)
    out = np.zeros((n, columns), bool)
    by_column = np.ascontiguousarray(symbols.T)
    for c in range(width - 1, -1, -1):
        bwt = by_column[c][order]
        moved = np.argsort(bwt, kind="stable")
        sorted_symbol = bwt[moved]
        same = np.zeros(n, bool)
        same[1:] = (sorted_symbol[1:] == sorted_symbol[:-1]) & (sorted_symbol[1:] >= 0)
        fresh = np.zeros(n, np.uint8)
        k = np.flatnonzero(same)
        if len(k):
            least = common[moved[k]]
            far = np.flatnonzero(moved[k] - moved[k - 1] > 1)
            if len(far):
                ends = np.append(common, np.uint8(0))
                pairs = np.stack([moved[k[far] - 1] + 1, moved[k[far]] + 1], 1).ravel()
                least[far] = np.minimum.reduceat(ends, pairs)[::2]
            fresh[k] = np.minimum(least, 200) + 1
        order, common = order[moved], fresh
        if c < columns:
            run = common >= length
            starts = np.flatnonzero(~run)
            if run.any():
                ranks = rank[order]
                least_rank = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, n)))
                out[order, c] = ranks != least_rank
    return out


class _Rounds:
    """The questions of the operator, in the order in which they are asked."""

    def __init__(self, id_col: str, text: str, length: int, n_owners: int, hot_contexts: int):
        self.id_col, self.text, self.length, self.n_owners, self.hot_contexts = id_col, text, length, n_owners, hot_contexts
        self.columns = length - GRAM + 1

    def anchors(self, documents: pa.Table) -> Anchors:
        return Anchors(documents, self.id_col, self.text, self.length)

    # first question: does the anchor occur elsewhere, and in how many contexts?
    def ask_anchors(self, documents: pa.Table) -> Iterator[tuple[int, bytes]]:
        a = self.anchors(documents)
        pairs, *_ = distinct_keys(a.hash, a.keys.spans(a.first, a.last + self.length, 0))
        distinct, counts = np.unique(pairs[:, 0], return_counts=True)
        for owner, share in shares(distinct, self.n_owners):
            yield owner, distinct[share].astype(np.uint32).tobytes() + np.minimum(counts[share], 65_535).astype(np.uint16).tobytes()

    def answer_anchors(self, blocks: list[int], asked: list[bytes]) -> list[bytes]:
        sizes = [len(x) // 6 for x in asked]
        keys = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(asked, sizes, strict=True)])
        counts = np.concatenate([np.frombuffer(x, np.uint16, n, 4 * n) for x, n in zip(asked, sizes, strict=True)])
        _, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, weights=counts)[which]
        cuts = np.cumsum(sizes)[:-1]
        return [bits(np.concatenate(x)) for x in zip(np.split(total > 1, cuts), np.split(total > self.hot_contexts, cuts), strict=True)]

    def known_anchors(self, a: Anchors, replies: dict[int, bytes]) -> np.ndarray:
        """What is known of each anchor."""
        distinct, which, count = np.unique(a.hash, return_inverse=True, return_counts=True)
        said = (count > 1).astype(np.uint8)
        for owner, share in shares(distinct, self.n_owners):
            repeated, hot = flags(replies[owner], 2 * (share.stop - share.start)).reshape(2, -1)
            said[share] = np.where(hot, HOT, said[share] | repeated)
        return said[which]

    # second question: which windows of repeated anchors start earlier elsewhere?
    def ask_windows(self, documents: pa.Table, replies: dict[int, bytes] | None) -> Iterator[tuple[int, bytes]]:
        a = self.anchors(documents)
        state = self.known_anchors(a, replies) if replies else np.zeros(len(a.hash), np.uint8)
        yield NOTE, state.tobytes()
        first, _, texts = a.contexts(np.flatnonzero(state == REPEATED))
        for owner, share in shares(a.hash[first], self.n_owners):
            f = first[share]
            yield owner, pack_columns(anchor=a.hash[f], doc=a.doc[f], start=(a.place[f] - a.first[f] + a.start[f]).astype(np.int64), column=(self.columns - 1 - (a.place[f] - a.first[f])).astype(np.int16), text=texts[share])
        _, doc, start, keys, index, _ = self.hot_windows(a, state)
        for owner, share in shares(keys[:, 0], self.n_owners):
            i = index[share]
            yield self.n_owners + owner, pack_columns(window=keys[share, 0], again=keys[share, 1], doc=doc[i], start=start[i])

    def hot_windows(self, a: Anchors, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows of hot anchors, ascending by document and start: place, document, start; their
        distinct keys, where each stands first, and which of them each window has."""
        hot = np.flatnonzero(state == HOT)
        counts = a.last[hot] - a.first[hot] + 1
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        window, doc, start = (np.repeat(x[hot], counts) for x in (a.first, a.doc, a.start))
        window, start = window + step, start + step
        order = np.lexsort((start, doc))
        window, doc, start = window[order], doc[order], start[order]
        keys, index, which, _ = distinct_keys(*(a.keys.spans(window, window + self.length, k) for k in (0, 1)))
        return window, doc, start, keys, index, which

    def answer_windows(self, blocks: list[int], asked: list[bytes]) -> list[bytes]:
        tables = [unpack(x) for x in asked]
        sizes = [t.num_rows for t in tables]
        doc, start = (np.concatenate([column(t, c) for t in tables]) for c in ("doc", "start"))
        block = np.repeat(blocks, sizes)
        if "window" in tables[0].column_names:
            window, again = (np.concatenate([column(t, c) for t in tables]) for c in ("window", "again"))
            order = np.lexsort((block, start, doc, again, window))
            repeat = np.zeros(len(order), bool)
            repeat[order[1:]] = (window[order][1:] == window[order][:-1]) & (again[order][1:] == again[order][:-1])
            return [bits(x) for x in np.split(repeat, np.cumsum(sizes)[:-1])]
        anchor, at = (np.concatenate([column(t, c) for t in tables]) for c in ("anchor", "column"))
        rank = np.empty(len(doc), np.int64)
        rank[np.lexsort((block, start, doc))] = np.arange(len(doc))
        text, offsets = text_buffer(pa.chunked_array([c for t in tables for c in t.column("text").chunks]))
        lengths = np.diff(offsets)
        order = np.argsort(anchor, kind="stable")
        new = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
        out = np.zeros((len(doc), self.columns), bool)
        begin = 0
        while begin < len(order):
            k = np.searchsorted(new, begin + BATCH)
            end = int(new[k]) if k < len(new) else len(order)
            if k and new[k - 1] > begin and end - begin > BATCH:
                end = int(new[k - 1])
            part = order[begin:end]
            symbols = np.full((len(part), 2 * self.columns + GRAM - 2), -1, np.int16)
            step = np.arange(lengths[part].sum()) - np.repeat(np.cumsum(lengths[part]) - lengths[part], lengths[part])
            symbols[np.repeat(np.arange(len(part)), lengths[part]), np.repeat(at[part], lengths[part]) + step] = text[np.repeat(offsets[part], lengths[part]) + step]
            out[part] = earlier_windows(symbols, rank[part], self.length, self.columns)
            begin = end
        return [bits(x) for x in np.split(out, np.cumsum(sizes)[:-1])]

    def gone(self, documents: pa.Table, replies: dict[int, bytes] | None) -> tuple[Anchors, np.ndarray]:
        """The block's bytes that go."""
        a = self.anchors(documents)
        starts = [np.zeros(0, np.int64)]
        if replies:
            state = np.frombuffer(replies[NOTE], np.uint8)
            some = np.flatnonzero(state == REPEATED)
            first, which, _ = a.contexts(some)
            again = np.setdiff1d(some, first, assume_unique=True)  # a context that the block has earlier
            counts = a.last[again] - a.first[again] + 1
            starts.append(np.repeat(a.first[again], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
            for owner, share in shares(a.hash[first], self.n_owners):
                f = first[share]
                which, at = np.nonzero(flags(replies[owner], len(f) * self.columns).reshape(len(f), self.columns))
                starts.append(a.first[f][which] + at - (self.columns - 1 - (a.place[f] - a.first[f]))[which])
            window, _, _, keys, index, which = self.hot_windows(a, state)
            earlier = np.zeros(len(keys), bool)
            for owner, share in shares(keys[:, 0], self.n_owners):
                earlier[share] = flags(replies[self.n_owners + owner], share.stop - share.start)
            starts.append(window[earlier[which] | (index[which] != np.arange(len(window)))])
        return a, covered(len(a.data), np.concatenate(starts), self.length)


def suffix_dedup(docs: DataFrame, columns: list[str] | None = None, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """id_col and `columns` of each document, kept (binary: the bytes that stay), n_bytes, n_removed
    and n_spans (removed runs). A byte goes if a string of `length` bytes that covers it also starts
    in a document of smaller id, or earlier in the same document."""
    if not GRAM < length <= 200:
        raise ValueError(f"length: over {GRAM}, at most 200")
    spark = docs.sparkSession
    others = list(dict.fromkeys([id_col, *(c for c in columns or () if c != text and c.lower() not in MADE)]))
    blocks = text_blocks(docs.withColumn(id_col, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))), [*others, text], text)
    size = total_bytes(blocks)
    rounds = _Rounds(id_col, text, length, owners(spark, size // 16, 500_000), hot_contexts)
    told = with_replies(blocks, ask(blocks, size, rounds.ask_anchors, rounds.answer_anchors))
    told = with_replies(blocks, ask(told, size, rounds.ask_windows, rounds.answer_windows))
    fields = [T.StructField(id_col, T.LongType()), *(docs.schema[c] for c in others[1:]), T.StructField("kept", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))]
    schema = to_arrow_schema(T.StructType(fields))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, documents, replies in each_block(batches, True):
            a, gone = rounds.gone(documents, replies)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = a.offsets[:-1][np.diff(a.offsets) > 0]
            begins[inner] = gone[inner]
            removed, spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[a.offsets]) for x in (gone, begins))
            kept, ends = a.data[~gone], np.concatenate([[0], np.cumsum(~gone)])[a.offsets]
            texts = pa.array([kept[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            out = pa.table([*(documents.column(c) for c in others), texts, pa.array(np.diff(a.offsets)), pa.array(removed), pa.array(spans)], names=[f.name for f in fields])
            yield from out.cast(schema).to_batches()

    return told.select("block", "payload", "replies").mapInArrow(finish, T.StructType(fields)).withColumn(id_col, F.nullif(id_col, F.lit(NO_ID)))


def digest(deduped: DataFrame) -> DataFrame:
    """The operator's result with a digest in place of the bytes."""
    return deduped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

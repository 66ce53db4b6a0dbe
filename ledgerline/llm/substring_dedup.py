"""Substring dedup by level-wise doubling.

All windows of a short length are counted over the corpus. Where a window is repeated, and the
one right after it too, the two are joined to a window of twice the length, and so on up to the
wanted length (the last step joins two overlapping windows). A window whose part is unique
cannot be repeated, so each level looks at the survivors of the one before only.

Levels before the last compare 32 bits of a key beside the owner's share, which may keep a
unique window as a candidate; the last level compares keys of 128 bits, salted anew in each run (see rolling).

Defined cases: null and empty text, or text of fewer words than a window, loses nothing;
repeated rows are documents of their own, so their windows are repeated; an empty table gives
no rows; columns not asked for are ignored, and so are those named like one of the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import NOTE, ask, bits, each_block, flags, owners, repeated_in, shares, text_blocks, total_bytes, with_replies
from ledgerline.llm.rolling import Words, covered, distinct_keys, fresh_salts, text_buffer

WORDS = 35
#: Names of the results.
MADE = ("kept", "n_words", "n_removed")


def levels(length: int, start: int = 9) -> list[int]:
    """Window lengths: doubled from about `start` up to `length`."""
    out = [length]
    while out[0] > start:
        out.insert(0, -(-out[0] // 2))
    return out


class _Levels:
    """The windows of a block at each level, and what the owners said of them."""

    def __init__(self, length: int, n_owners: int, text: str):
        self.steps, self.n_owners, self.text = levels(length), n_owners, text
        self.salts = fresh_salts()

    def kind(self, k: int) -> tuple[type, int]:
        """Type and lanes of the keys that a level sends."""
        return (np.uint64, 2) if k == len(self.steps) - 1 else (np.uint32, 1)

    def words(self, documents: pa.Table) -> Words:
        return Words(*text_buffer(documents.column(self.text)), salts=self.salts)

    def windows(self, words: Words, k: int, before: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """First words of the windows that may be repeated, their distinct keys, which of them each has,
        and how often it is in the block. before: words where a window of the last level is repeated."""
        at = None
        if k:
            ahead = self.steps[k] - self.steps[k - 1]
            at = np.flatnonzero(before)
            at = at[at + ahead < len(before)]
            at = at[before[at + ahead]]
        at, *h = words.windows(self.steps[k], at, self.kind(k)[1])
        keys, _, which, count = distinct_keys(*h)
        return at, keys, which, count

    def repeated(self, words: Words, k: int, replies: dict[int, bytes]) -> np.ndarray:
        """For each word, whether the window of level k that starts there occurs elsewhere too."""
        at, distinct, which, count = self.windows(words, k, flags(replies[NOTE], len(words.start)) if k else None)
        there = count > 1
        for owner, share in shares(distinct[:, 0], self.n_owners):
            there[share] |= flags(replies[owner], share.stop - share.start)
        out = np.zeros(len(words.start), bool)
        out[at[there[which]]] = True
        return out

    def request(self, k: int):
        def of(documents: pa.Table, replies: dict[int, bytes] | None = None) -> Iterator[tuple[int, bytes]]:
            words = self.words(documents)
            before = None
            if k:
                before = self.repeated(words, k - 1, replies)
                yield NOTE, bits(before)
            distinct = self.windows(words, k, before)[1]
            for owner, share in shares(distinct[:, 0], self.n_owners):
                yield owner, distinct[share].astype(self.kind(k)[0]).tobytes()

        return of


def _kept(words: Words, gone: np.ndarray) -> pa.Array:
    """For each text, the words that stay, joined by one space."""
    stay = np.flatnonzero(~gone)
    lengths = words.end[stay] - words.start[stay] + 1
    ends = np.cumsum(lengths)
    begin = ends - lengths
    out = words.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.start[stay] - 1 - begin, lengths)]
    out[begin] = 0x20
    last = np.concatenate([[0], ends])[np.searchsorted(stay, words.first)]
    texts = [out[a + 1 : b].tobytes() if b > a else b"" for a, b in zip(last[:-1], last[1:], strict=True)]
    return pa.array(texts, pa.binary()).cast(pa.string())


def substring_dedup(docs: DataFrame, columns: list[str], text: str = "text", length: int = WORDS) -> DataFrame:
    """`columns` of each document (text replaced by `kept`: the words left, joined by one space),
    n_words and n_removed. A word goes if a window of `length` words that covers it also starts
    at any other place of the corpus."""
    spark = docs.sparkSession
    others = [c for c in dict.fromkeys(columns) if c != text and c.lower() not in MADE]
    blocks = text_blocks(docs, [*others, text], text)
    size = total_bytes(blocks)
    # about six bytes a word; an owner's share stays bounded even if every window is a key
    level = _Levels(length, owners(spark, size // 6), text)
    told = blocks
    for k in range(len(level.steps)):
        told = with_replies(blocks, ask(told, size, level.request(k), repeated_in(*level.kind(k))))
    fields = [docs.schema[c] for c in others] + [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    schema = to_arrow_schema(T.StructType(fields))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, documents, replies in each_block(batches, True):
            words = level.words(documents)
            gone = covered(len(words.start), np.flatnonzero(level.repeated(words, len(level.steps) - 1, replies)) if replies else np.zeros(0, np.int64), length)
            total = np.concatenate([[0], np.cumsum(gone)])[words.first]
            out = pa.table([*(documents.column(c) for c in others), _kept(words, gone), pa.array(np.diff(words.first)), pa.array(np.diff(total))], names=[f.name for f in fields])
            yield from out.cast(schema).to_batches()

    return told.select("block", "payload", "replies").mapInArrow(finish, T.StructType(fields))


def digest(deduped: DataFrame) -> DataFrame:
    """The operator's result with a digest in place of the text."""
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

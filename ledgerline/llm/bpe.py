"""BPE encoding and decoding through a table of distinct words.

Every block of documents splits its texts at ASCII white space, which the tokenizer's own word
pattern never crosses (other white space may stand inside a word and is left to the tokenizer), and sends its distinct words to the partitions that own them. Each owner
encodes each distinct word once. The ids come back in the order in which the words were sent and
are joined by position in the text; decoding joins ids to pieces through the vocabulary, a table
whose size the tokenizer fixes.

The library's tokenizer encodes the words, so its normalization (composed characters, lower
case), word pattern, merges and special tokens inside words apply unchanged. This holds for
tokenizers that drop white space; others are refused.

Defined cases: null and empty text has no ids and decodes to empty text; ties and repeated rows
are encoded alike; an empty table gives no rows; columns not asked for are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_64_intdigest

from ledgerline.llm.common import ask, column, each_block, owners, pack, text_blocks, total_bytes, unpack, with_replies
from ledgerline.llm.rolling import text_buffer

BLOCK = 8 << 20
#: Words whose ids and text are laid out at a time.
PART = 200_000
#: Names of the results; columns so named are not carried.
MADE = ("n_tokens", "ids", "decoded")
_loaded: dict = {}


def _tokenizer(path: str):
    """The tokenizer, and its pieces by id."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        if json.loads(t.to_str())["decoder"] is not None or t.encode("a b", add_special_tokens=False).ids != [i for w in "ab" for i in t.encode(w, add_special_tokens=False).ids]:
            raise ValueError(f"{path}: not a tokenizer that drops white space")
        by_id = {i: p for p, i in t.get_vocab(with_added_tokens=True).items()}
        _loaded[path] = t, [by_id.get(i, "") for i in range(max(by_id) + 1)]
    return _loaded[path]


class _Words:
    """A block's distinct words, in the order of their owners, and what the owners said of them."""

    def __init__(self, path: str, n_owners: int):
        self.path, self.n_owners = path, n_owners

    def split(self, documents: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Where each text's words start (one number more), which word stands at each place, the
        distinct words, and where the words of each owner start (one number more)."""
        texts = documents.column("text").combine_chunks()
        texts = texts if isinstance(texts, pa.Array) else texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        owner = np.array([xxh3_64_intdigest(w) % self.n_owners for w in words.to_pylist()], np.int64)
        order = np.argsort(owner, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return first, place[which], words.take(pa.array(order)), np.searchsorted(owner[order], np.arange(self.n_owners + 1))

    def request(self, documents: pa.Table) -> Iterator[tuple[int, bytes]]:
        _, _, words, starts = self.split(documents)
        for k in range(self.n_owners):
            if starts[k] < starts[k + 1]:
                yield k, pack(pa.table({"word": words.slice(starts[k], starts[k + 1] - starts[k])}))

    def answer(self, blocks: list[int], asked: list[bytes]) -> list[bytes]:
        tokenizer, _ = _tokenizer(self.path)
        tables = [unpack(x) for x in asked]
        coded = pa.concat_arrays([c for t in tables for c in t.column("word").chunks]).dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy()
        lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for k in range(0, len(words), 4_000):  # some distinct words at a time
            for e in tokenizer.encode_batch_fast(words.slice(k, 4_000).to_pylist(), add_special_tokens=False):
                x = e.ids
                lengths.append(len(x))
                ids.append(x)
        lengths = np.array(lengths[1:], np.int64)
        flat = np.fromiter((i for x in ids[1:] for i in x), np.uint32, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        out, at = [], 0
        for t in tables:
            w = which[at : at + t.num_rows]
            at += t.num_rows
            n = lengths[w]
            take = np.repeat(starts[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            small = np.uint8 if n.max(initial=0) < 256 else np.uint32
            out.append(pack(pa.table({"n": n.astype(small)})) + b"|ids|" + pack(pa.table({"id": flat[take].astype(np.uint16 if flat[take].max(initial=0) < 65536 else np.uint32)})))
        return out

    def ids(self, starts: np.ndarray, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each distinct word has, and the ids of all one after the other."""
        n, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for k in range(self.n_owners):
            if starts[k] < starts[k + 1]:
                a, b = (unpack(x) for x in replies[k].split(b"|ids|", 1))
                n.append(column(a, "n").astype(np.int64))
                ids.append(column(b, "id").astype(np.uint32))
        return np.concatenate(n), np.concatenate(ids)


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def bpe_round_trip(docs: DataFrame, columns: list[str], path: str, text: str = "text") -> DataFrame:
    """`columns` of each document, n_tokens, ids (binary: little-endian unsigned 32-bit integers)
    and decoded (the pieces of the ids, joined by one space, as the tokenizer without decoder does)."""
    spark = docs.sparkSession
    others = [c for c in dict.fromkeys(columns) if c not in (text, "text") and c.lower() not in MADE]
    blocks = text_blocks(docs.select(*others, F.col(text).alias("text")), [*others, "text"], "text", BLOCK)
    size = total_bytes(blocks)
    words = _Words(path, owners(spark, size // 24, 500_000))
    told = with_replies(blocks, ask(blocks, size, words.request, words.answer))
    fields = [*(docs.schema[c] for c in others), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    schema = to_arrow_schema(T.StructType(fields))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, offsets = text_buffer(pa.array([p + " " for p in _tokenizer(path)[1]], pa.string()))
        sizes = np.diff(offsets)
        for _, documents, replies in each_block(batches, True):
            first, which, words_of, starts = words.split(documents)
            n, flat = words.ids(starts, replies or {})
            del words_of
            begin, at = np.cumsum(n) - n, 0
            while at < documents.num_rows:  # about PART words at a time
                end = max(at + 1, int(np.searchsorted(first, first[at] + PART, side="right")) - 1)
                w = which[first[at] : first[end]]
                ids = flat[_gather(begin[w], n[w])]
                text = pieces[_gather(offsets[ids], sizes[ids])]
                id_ends = np.concatenate([[0], np.cumsum(n[w])])[first[at : end + 1] - first[at]]
                text_ends = np.concatenate([[0], np.cumsum(sizes[ids])])[id_ends]
                encoded = [ids[x:y].astype("<u4").tobytes() for x, y in zip(id_ends[:-1], id_ends[1:], strict=True)]
                decoded = [text[x : max(x, y - 1)].tobytes() for x, y in zip(text_ends[:-1], text_ends[1:], strict=True)]
                made = [pa.array(np.diff(id_ends)), pa.array(encoded, pa.binary()), pa.array(decoded, pa.binary()).cast(pa.string())]
                out = pa.table([*(documents.column(c).slice(at, end - at) for c in others), *made], names=[f.name for f in fields])
                yield from out.cast(schema).to_batches()
                at = end

    return told.select("block", "payload", "replies").mapInArrow(finish, T.StructType(fields))


def digest(encoded: DataFrame) -> DataFrame:
    """The operator's result with digests in place of ids and text."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

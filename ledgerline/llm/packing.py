"""Best-fit packing of token pieces by a configuration linear program.

A configuration says how many pieces of each length one sequence holds. The linear program
asks for the fewest sequences whose configurations cover the length histogram. It is solved
by multiplicative weights: a knapsack dynamic program prices all room, near-best configurations of its table are used in
fractions, and the weights of lengths that went short grow. The knapsack's value also bounds the program from below. The
fractions are rounded to whole numbers and the rest is a program of its own, down to a few pieces for
best-fit decreasing, which is also what no plan may exceed. All of this sees only the histogram (as many rows as
there are lengths, so the capacity bounds it); the pieces get their places in Spark.

Defined cases: null and empty text is one piece that holds the terminator alone; ties and
repeated rows are pieces of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import array
import base64
import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerline.llm.common import materialize

CAPACITY = 2048
TERMINATOR = 0
#: Distinct words whose ids one Python worker remembers, and the longest of them.
REMEMBERED, LONGEST = 250_000, 64
#: Letters of a text that are cut in words at a time.
CHUNK = 1 << 20
#: Pieces whose ranks one window task assigns.
RANK_BUCKET = 20_000
#: Rounds of multiplicative weights, levels of rounding, the step of a weight, and the shares of the best
#: price that a configuration may lack (a solution of each in every round).
ROUNDS, LEVELS, ETA, WITHIN = 3, 3, 0.1, (1.0, 0.01, 0.0005)
#: Prices are whole numbers, so that equal prices are exactly equal: a sequence's at weight one, and none at all.
UNIT, NEVER = 1 << 32, -(1 << 60)

# A word with the single white space before it. Byte-level BPE's own pattern begins a word wherever one plain
# white space stands between two other characters; any other white space stays inside a word here.
_WORD = re.compile(r"(?:\A\s+|[ \n\t\r])?\S+(?:(?![ \n\t\r]\S)\s+\S+)*(?:\s+\Z)?|\A\s+\Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACES = re.compile(r"\s")
_encoders: dict = {}


class _Encoder:
    """The tokenizers library's ids as little-endian unsigned 32-bit integers. Text is cut in words, which the
    tokenizer's word pattern never joins, and the ids of short words are remembered. Most cuts are single
    spaces; only where other white space stands is a text looked at more closely. New words go
    through the same vocabulary as ranks, which is three times as fast; words with white space inside
    or a special token go through the library itself."""

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([r".\s", *special]), re.S)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}  # words behind a space
        self.others: dict[str, bytes] = {}  # words with the white space before them

    def encode(self, word: str) -> bytes:
        odd = self.odd.search(word)
        return array.array("I", self.tokenizer.encode(word, add_special_tokens=False).ids if odd else self.plain(word)).tobytes()

    def careful(self, text: str) -> bytes:
        out = []
        for w in _WORD.findall(text):
            x = self.others.get(w)
            if x is None:
                x = self.encode(w)
                if len(w) < LONGEST and len(self.others) < REMEMBERED // 2:
                    self.others[w] = x
            out.append(x)
        return b"".join(out)

    def chunk(self, text: str, spaced: bool) -> bytes:
        """Ids of a text that stands behind a space (spaced) or begins."""
        words, known = text.split(" "), self.known
        out = list(map(known.get, words))
        if not spaced:
            out[0] = None
        if None in out:
            for k, x in enumerate(out):
                if x is None:
                    w = words[k]
                    if not w or w[0].isspace() or w[-1].isspace():  # a run of white space
                        return self.careful(f" {text}" if spaced else text)
                    if k == 0 and not spaced:
                        out[k] = self.careful(w)
                    elif _SPACES.search(w):
                        out[k] = self.careful(f" {w}")
                    else:
                        out[k] = x = known.get(w) or self.encode(f" {w}")
                        if len(w) < LONGEST and len(known) < REMEMBERED:
                            known[w] = x
        return b"".join(out)

    def __call__(self, text: str) -> bytes:
        out, at = [], 0
        while len(text) - at > CHUNK and (m := _CUT.search(text, at + CHUNK)):
            out.append(self.chunk(text[at : m.start()], at > 0))
            at = m.end()
        return b"".join([*out, self.chunk(text[at:], at > 0)]) if text else b""


def _encoder(path: str, ranks_path: str) -> _Encoder:
    import public_tokenizers

    if (path, ranks_path) not in _encoders:
        _encoders[path, ranks_path] = _Encoder(path, ranks_path, public_tokenizers.PATTERN)
    return _encoders[path, ranks_path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, terminator: int = TERMINATOR) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    end = np.array([terminator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                view = memoryview(ids)
                rows += [(i, k, s, n, zlib.crc32(view[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _best_values(price: np.ndarray, capacity: int) -> np.ndarray:
    """The largest total price of pieces (any number of each length) that fit in each room."""
    best, some = np.zeros(capacity + 1, price.dtype), np.flatnonzero(price > 0)
    dense = 4 * len(some) > capacity
    for c in range(int(some[0]), capacity + 1):
        if dense:
            top = (price[1 : c + 1] + best[c - 1 :: -1][:c]).max()
        else:
            k = some[: np.searchsorted(some, c, side="right")]
            top = (price[k] + best[c - k]).max()
        best[c] = max(top, best[c - 1])
    return best


Plan = list[tuple[dict[int, int], int]]


def best_fit_decreasing(demand: np.ndarray, capacity: int) -> Plan:
    """Longest pieces first, each into the fullest sequence that has room for it. Sequences filled alike are
    one row with a count, so the work follows the lengths, not the pieces."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}  # sequences by their room
    rooms: list[int] = []  # ascending
    for n in np.flatnonzero(demand)[::-1].tolist():
        left = int(demand[n])

        def put(config: dict[int, int], times: int, room: int) -> None:
            if room not in open_:
                open_[room] = []
                bisect.insort(rooms, room)
            open_[room].append((config, times))

        while left:
            at = bisect.bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                config, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, config, times = capacity, {}, left
            each = room // n
            full = min(times, left // each)
            if full:
                put({**config, n: each}, full, room - each * n)
            left -= full * each
            if times > full:
                some = min(left, each)  # fewer than each, if any: the last pieces of this length
                if some:
                    put({**config, n: some}, 1, room - some * n)
                    left -= some
                if config and times - full - (some > 0):
                    put(config, times - full - (some > 0), room)
    return [x for room in rooms for x in open_[room]]


def _near_best(left: np.ndarray, price: np.ndarray, best: np.ndarray, capacity: int, budget: float, within: float) -> list[tuple[dict[int, int], float]]:
    """Configurations of the greatest price for each length, from the knapsack's table, if they come within a
    share of the best price of all, each used as often as its pieces last, until the budget of
    sequences is spent. `left` is used up."""
    out, spent = [], 0.0
    usable = np.where(left > 0, price, NEVER)
    for longest in np.flatnonzero(left > 0)[::-1].tolist():
        while left[longest] > 0 and spent < budget:
            counts, room, n = {}, capacity, longest
            while room:
                # as many at once as the table would take one by one
                path = best[room::-n]
                same = path[:-1] - path[1:] == price[n]
                run = len(same) if same.all() else int(same.argmin())
                k = max(1, min(run, int(left[n]) - counts.get(n, 0)))
                counts[n] = counts.get(n, 0) + k
                room -= k * n
                if counts[n] + 1 > left[n]:
                    usable[n] = NEVER
                if not room:
                    break
                gains = usable[room:0:-1] + best[:room]  # by the room that is left then
                at = int(gains.argmax())  # the longest of equals: short pieces fit later as well
                if gains[at] < 0:
                    break
                n = room - at
            good = sum(k * price[n] for n, k in counts.items()) >= (1 - within) * best[capacity]
            times = min(budget - spent, min(left[n] / k for n, k in counts.items())) if good else 0.0
            for n, k in counts.items():
                left[n] = max(0.0, left[n] - k * times)
                if left[n] < 1e-9:
                    left[n] = 0.0
                usable[n] = price[n] if left[n] else NEVER
            if times < 1e-9:
                break
            out.append((counts, times))
            spent += times
    return out


Fractions = list[tuple[dict[int, int], float]]


def fractional_configurations(demand: np.ndarray, capacity: int, rounds: int = ROUNDS, eta: float = ETA) -> Iterator[tuple[Fractions, float]]:
    """Fractional solutions of the linear program (some of each round, then their average), each with the lower bound so far.
    Every length has a weight; its price is its weight times its share of a sequence. In a round the
    knapsack prices all room; its value gives a dual bound, and near-best configurations are used as often as that bound
    says, no length more often than its demand. Then a length's weight is multiplied by (1 + eta) to the power of the
    share of its demand that went unused."""
    lengths, some = np.arange(capacity + 1), demand > 0
    weight, bound, total = np.ones(capacity + 1), 0.0, {}
    for _ in range(rounds):
        price = np.where(some, np.rint(weight * lengths * (UNIT // capacity)), 0).astype(np.int64)
        best = _best_values(price, capacity)
        bound = max(bound, float(demand.astype(float) @ price) / float(best[capacity]))
        missed = np.zeros(capacity + 1)
        for within in WITHIN:
            left = demand.astype(float)
            fractions = _near_best(left, price, best, capacity, bound, within)
            yield fractions, bound
            for config, times in fractions:
                key = tuple(config.items())
                total[key] = total.get(key, 0.0) + times / (rounds * len(WITHIN))
            missed += np.divide(left, demand, out=np.zeros(capacity + 1), where=some) / len(WITHIN)
        weight = weight * (1 + eta) ** missed
        weight /= weight[some].min()
    yield sorted(((dict(key), x) for key, x in total.items()), key=lambda c: -c[1]), bound


def _rounded(fractions: Fractions, left: np.ndarray, carry: bool) -> Plan:
    """Whole numbers, rounded down; with carry, their running sum is kept to that of the fractions. No more than the
    pieces last; these are taken from left."""
    carried, out = 0.0, []
    for config, x in fractions:
        carried = carried + x if carry else x
        times = min(int(carried + 1e-9), *(int(left[n]) // k for n, k in config.items()))
        if times > 0:
            out.append((config, times))
            carried -= times
            for n, k in config.items():
                left[n] -= k * times
    return out


def solve_configurations(histogram: dict[int, int], capacity: int, report: list[dict] | None = None) -> Plan:
    """(configuration, times) pairs that hold exactly the histogram's pieces. The program's fractional solutions are
    rounded; with each, what its whole numbers leave is packed by best-fit decreasing, and the solution with the fewest
    sequences in all is taken. Its rest is then a program
    of its own. Where best-fit decreasing alone needs fewer sequences than every rounded solution it is taken, so the plan is
    never longer than its plan. report: gets a row a level (pieces, bound, best_fit of all, rounded sequences, residue)."""
    left = np.zeros(capacity + 1, np.int64)
    for n, k in histogram.items():
        left[n] = k
    used: Plan = []
    rest = best_fit_decreasing(left, capacity)
    for _ in range(LEVELS):
        n_rest = sum(k for _, k in rest)
        if not n_rest:
            break
        found, bound = [], 0.0
        for fractions, bound, carry in ((*x, carry) for x in fractional_configurations(left, capacity) for carry in (False, True)):
            after = left.copy()
            step = _rounded(fractions, after, carry)
            then = best_fit_decreasing(after, capacity)
            total = sum(k for _, k in step) + sum(k for _, k in then)
            if step and total <= n_rest:
                found.append(((total, int(after.sum())), step, then, after))
                if total <= np.ceil(bound - 1e-6):  # no plan is shorter
                    break
        # sequences within a ten-thousandth are as few: of these, the one with the fewest pieces left
        least = min((x[0][0] for x in found), default=0)
        chosen = min((x for x in found if x[0][0] <= least + n_rest // 10_000), key=lambda x: x[0][::-1], default=None)
        if report is not None:
            report.append({"pieces": int(left.sum()), "bound": bound, "best_fit": n_rest, "rounded": sum(k for _, k in chosen[1]) if chosen else 0, "residue": chosen[0][1] if chosen else int(left.sum())})
        if chosen is None:
            break
        used, rest, left = used + chosen[1], chosen[2], chosen[3]
        if chosen[0][0] <= np.ceil(bound - 1e-6):
            break
    return used + rest


def least_sequences(histogram: dict[int, int], capacity: int) -> int:
    """A lower bound: by the tokens, and by the pieces of which no two fit in one sequence."""
    return max(-(-sum(n * k for n, k in histogram.items()) // capacity), sum(k for n, k in histogram.items() if 2 * n > capacity))


def _places(plan: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, ...]:
    """For each run of ranks of one length: key (length and first rank), first sequence, pieces
    of that length in a sequence, and the offset of the first of them."""
    keys, first, each, offset = [], [], [], []
    used: dict[int, int] = {}
    sequence = 0
    for config, times in plan:
        at = 0
        for n in sorted(config, reverse=True):
            k = config[n]
            keys.append((n << 44) | used.get(n, 0))
            used[n] = used.get(n, 0) + k * times
            first.append(sequence)
            each.append(k)
            offset.append(at)
            at += n * k
        sequence += times
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return tuple(np.array(x, np.int64)[order] for x in (keys, first, each, offset))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with `length` (1 to capacity). `pieces` is read
    twice: pass a table, not a plan that computes it."""
    spark = pieces.sparkSession
    # ranks within a length, without gathering a length in one task: count by bucket, then rank in it
    total = pieces.count()
    buckets = max(16, -(-total // RANK_BUCKET))
    salted = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = salted.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    keys, first, each, offset = _places(solve_configurations(histogram, capacity))
    base = counts.withColumn("_base", F.sum("_n").over(W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)))
    in_bucket = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("_k", in_bucket.cast("long")).join(base.select("length", "_bucket", "_base"), ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.coalesce("_base", F.lit(0)) + F.col("_k") - 1).drop("_bucket", "_k", "_base")
    names = pieces.columns
    shared = spark.sparkContext.broadcast((keys, first, each, offset))  # bounded by the configurations

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, each, offset = shared.value
        for b in batches:
            n, rank = np.asarray(b.column("length")), np.asarray(b.column("_rank"))
            at = np.searchsorted(keys, (n << 44) | rank, side="right") - 1
            k = rank - (keys[at] & ((1 << 44) - 1))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(first[at] + k // each[at]), pa.array(offset[at] + k % each[at] * n)], [*names, "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def best_fit_packing(docs: DataFrame, path: str | None = None, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document of docs (doc_id, text), tokenized, ended by the terminator, cut and packed.
    path: the tokenizer; ranks_path: its vocabulary as ranks."""
    import public_tokenizers as P

    pieces = token_pieces(docs, path or P.path("byte_bpe_50k.json"), ranks_path or P.path("byte_bpe_50k.tiktoken"), capacity=capacity)
    return pack_pieces(materialize(pieces), capacity)

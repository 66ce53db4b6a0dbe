"""N-gram Jaccard join by T-occurrence search.

A document is the set of keys of its word n-grams (64 bits each, salted anew in each run, so that no text can be
written to meet another's). Documents with equal sets (by a signature of 128 bits, half of it from a second, independent key
of each n-gram) form a class and one of them stands for all. A set of n shingles can only link
with sets that share at least T = ceil(n * 85 / 100) of them, so every class counts how many of its
shingles occur in other classes at all: those with fewer than T are alone and go no further. The others
keep their shared shingles, rarest first; two that link have a shingle in common among the n - T + 1 rarest.

Classes that share such a shingle form groups (a superset of the links). In a group, each class
searches the inverted lists of the classes before it: the short lists, of its rarest shingles,
are merged and give the candidates; the long ones are probed for those by binary search
(DivideSkip), and candidates that reach the required overlap link. Candidates already in the
class's component are skipped, as only components are asked for. Different classes cannot have all
shingles in common, so such a pair, which only equal keys of different shingles could make, is no link.

A group of more than GROUP classes is split in blocks. Each block is searched by itself; the
least class of every component found stands for it, and these are searched again until they
fit or no longer shrink. What lies outside the group's largest component is then compared with the
whole group, in cells of two slices. A slice holds about GROUP classes of one band of set sizes; sets
that link are in one band or in neighbouring ones, so a band's slices meet only those.

Defined cases: null and empty text, or text without words, has no shingles and is a component of
its own; fewer words than n make one shingle; repeated rows are one class, and rows that share a doc_id
but not the text are classes of their own; a row without a doc_id links nothing, it has the component of
the rows with its set or null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import NO_ID, ask, column, each_block, materialize, owners, pack_columns, row_key, shares, text_blocks, total_bytes, unpack, with_replies
from ledgerline.llm.components import connected_components
from ledgerline.llm.rolling import Salts, Words, fresh_salts, mix, text_buffer

N = 4
PERCENT = 85
#: Classes that one task compares with each other.
GROUP = 2_000
#: Classes of small groups that one task searches.
TASK_CLASSES = 4_000
#: Candidates whose long lists are probed at first; four times as many each time after.
PROBED = 8
#: Candidates at a time from which on the long lists are merged instead.
MERGED = 128

_SIGNS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_shingles", "row", "sign", "sign2")])
_SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("shared", T.BinaryType())])
_EDGES = "a long, b long"


class Shingles:
    """Distinct shingle keys of each document of a block, ascending by document and key. twice: a second, independent
    key of each beside it."""

    def __init__(self, documents: pa.Table, n: int, salts: Salts, twice: bool = False):
        words = Words(*text_buffer(documents.column("text")), lower=True, salts=salts)
        at, h, *more = words.windows(n, lanes=1 + twice)
        counts = np.diff(words.first)
        short = np.flatnonzero((counts > 0) & (counts < n))
        doc = np.concatenate([words.text[at], short])
        h = np.concatenate([h, words.wholes(short)])
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        self.doc, self.hash = doc[new], h[new]
        if twice:
            self.second = np.concatenate([*more, words.wholes(short, 1)])[order][new]
        self.size = np.bincount(self.doc, minlength=documents.num_rows)
        self.ids = column(documents, "doc_id")

    def signs(self) -> list[np.ndarray]:
        """Two independent numbers that stand for each document's set, one from each key of its shingles; 0 without shingles."""
        some = np.flatnonzero(self.size)
        starts = (np.cumsum(self.size) - self.size)[some]
        out = []
        for keys in (self.hash, self.second):
            sums = np.zeros(len(self.size), np.uint64)
            if len(some):
                sums[some] = mix(np.add.reduceat(mix(keys.copy()), starts) ^ self.size[some].astype(np.uint64))
            out.append(sums.view(np.int64))
        return out


def _least(n: int | np.ndarray, percent: int):
    """Shingles that a set of n has in common with any set that it links with."""
    return -(-n * percent // 100)


class _Counts:
    """The question how many classes each shingle occurs in (as a rounded logarithm)."""

    def __init__(self, n: int, percent: int, n_owners: int, salts: Salts):
        self.n, self.percent, self.n_owners, self.salts = n, percent, n_owners, salts

    def chosen(self, documents: pa.Table, replies: dict[int, bytes]) -> Shingles:
        """The shingles of the block's documents that stand for a class."""
        s = Shingles(documents, self.n, self.salts)
        keep = np.zeros(len(s.size), bool)
        keep[np.frombuffer(replies[-1], np.int32)] = True
        keep = keep[s.doc]
        s.doc, s.hash = s.doc[keep], s.hash[keep]
        return s

    def request(self, documents: pa.Table, replies: dict[int, bytes] | None) -> Iterator[tuple[int, bytes]]:
        if replies:
            yield -1, replies[-1]
            distinct, count = np.unique(self.chosen(documents, replies).hash, return_counts=True)
            for owner, share in shares(distinct, self.n_owners):
                yield owner, pack_columns(key=distinct[share].astype(np.uint32), count=count[share].astype(np.int32))

    @staticmethod
    def answer(blocks: list[int], asked: list[bytes]) -> list[bytes]:
        tables = [unpack(x) for x in asked]
        keys = np.concatenate([column(t, "key") for t in tables])
        distinct, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, weights=np.concatenate([column(t, "count") for t in tables]))
        code = np.minimum(255, np.round(8 * np.log2(total))).astype(np.uint8)[which]
        return [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in np.split(code, np.cumsum([t.num_rows for t in tables])[:-1])]

    def survivors(self, documents: pa.Table, replies: dict[int, bytes]) -> Iterator[tuple[int, int, bytes]]:
        """(place in the block, set size, shared shingles rarest first) of the classes that may have links."""
        s = self.chosen(documents, replies)
        distinct, which = np.unique(s.hash, return_inverse=True)
        code = np.zeros(len(distinct), np.uint8)
        for owner, share in shares(distinct, self.n_owners):
            n = share.stop - share.start
            code[share] = np.frombuffer(pa.decompress(replies[owner], n, codec="zstd", asbytes=True), np.uint8)
        code = code[which]
        shared = np.bincount(s.doc[code > 0], minlength=len(s.size))
        may = (shared >= _least(s.size, self.percent)) & (shared > 0)
        pick = (code > 0) & may[s.doc]
        doc, h, code = s.doc[pick], s.hash[pick], code[pick]
        order = np.lexsort((h, code, doc))
        doc, h = doc[order], h[order]
        some, starts = np.unique(doc, return_index=True)
        for d, x in zip(some.tolist(), np.split(h, starts[1:]), strict=True) if len(some) else ():
            yield int(d), int(s.size[d]), x.tobytes()


def _links(ids: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets (shared shingles, rarest first): pairs of ids.
    side: 1 or 2 for each set; only links of two sides are wanted (3 is on both)."""
    count = len(ids)
    order = np.argsort(sizes, kind="stable")
    label = np.arange(count)  # component of each set, by its place in `order`
    members = [[k] for k in range(count)]
    rank = np.empty(count, np.int64)
    rank[order] = np.arange(count)
    rare = np.array([max(0, len(x) - int(_least(n, percent)) + 1) for x, n in zip(sets, sizes.tolist(), strict=True)], np.int64)
    shingle = np.concatenate(sets) if count else np.zeros(0, np.uint64)
    member = rank[np.repeat(np.arange(count), [len(x) for x in sets])]
    by = np.lexsort((member, shingle))
    # the inverted list of each shingle, ascending by rank
    _, first, which = np.unique(shingle[by], return_index=True, return_inverse=True)
    lists, ends = member[by], np.append(first[1:], len(by))
    mine = np.empty(len(by), np.int64)
    mine[by] = which
    mine = np.split(mine, np.cumsum([len(x) for x in sets])[:-1]) if count else []
    sized = sizes[order]
    sides = None if side is None else side[order]
    out: list[tuple[int, int]] = []
    for i in order.tolist():
        if not rare[i]:
            continue
        # merge the short lists, of the rarest shingles
        me = int(rank[i])
        short = [lists[first[k] : ends[k]] for k in mine[i][: rare[i]].tolist() if ends[k] - first[k] > 1]
        if not short:
            continue
        hits = np.bincount(np.concatenate(short), minlength=me)[:me]
        found = np.flatnonzero(hits)
        found = found[sized[found] * 100 >= percent * sizes[i]]
        if sides is not None:
            found = found[(sides[found] | sides[me]) == 3]
        need = -(-percent * (sized + sizes[i]) // (100 + percent))
        long_ = mine[i][rare[i] :].tolist()
        found = found[hits[found] + len(long_) >= need[found]]
        # probe the long lists for the candidates, the most promising first
        found = found[np.argsort(-hits[found], kind="stable")]
        size = PROBED
        while len(found := found[label[found] != label[me]]):
            some, found, size = found[:size], found[size:], 4 * size
            have, left = hits[some], len(long_)
            if long_ and size > MERGED:  # many candidates: merging the long lists costs less than so many searches
                have = have + np.bincount(np.concatenate([lists[first[k] : ends[k]] for k in long_]), minlength=count)[some]
            for k in long_ if size <= MERGED else ():
                left -= 1
                at = lists[first[k] : ends[k]]
                have = have + (at[np.minimum(np.searchsorted(at, some), len(at) - 1)] == some)
                may = have + left >= need[some]
                if not may.all():
                    some, have = some[may], have[may]
                    if not len(some):
                        break
            # all shingles in common would be the same class
            good = some[(have >= need[some]) & ~((have == sized[some]) & (have == sizes[i]))] if len(some) else some
            for j in good.tolist():
                if label[j] != label[me]:
                    out.append((int(ids[i]), int(ids[order[j]])))
                    a, b = sorted((int(label[j]), int(label[me])), key=lambda c: len(members[c]))
                    label[members[a]] = b
                    members[b] += members[a]
                    members[a] = []
    return out


def _linked(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (a, b) within each group of rows (keys, node, n, shared[, side])."""
    sided = "side" in rows.columns

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        parts = group.column("part").to_numpy() if "part" in group.column_names else np.zeros(group.num_rows, np.int64)
        ids, sizes = column(group, "node"), column(group, "n")
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shared")]
        side = column(group, "side") if sided else None
        out = []
        for p in np.unique(parts):
            k = np.flatnonzero(parts == p)
            out += _links(ids[k], sizes[k], [sets[i] for i in k], percent, None if side is None else side[k])
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return rows.groupBy(*keys).applyInArrow(run, _EDGES)


def _labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows with their component under `edges` (their own node without)."""
    found = connected_components(edges).withColumnRenamed("id", "node")
    return rows.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _cells(labelled: DataFrame, percent: int, group: int) -> DataFrame:
    """Rows (cell, node, n, shared, side) of every two slices of a part that may hold a link between a
    class outside the part's largest component and any other class."""
    totals = labelled.groupBy("part", "component").agg(F.count(F.lit(1)).alias("size"))
    top = totals.groupBy("part").agg(F.max_by("component", F.struct("size", "component")).alias("top"))
    # sets of sizes a <= b link only if a >= b * percent / 100, so their bands are at most one apart
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    marked = materialize(labelled.join(top, "part").select("part", "node", "n", "shared", (F.col("component") != F.col("top")).alias("asking"), band.alias("band")))
    counts = marked.groupBy("part", "band", "asking").agg(F.ceil(F.count(F.lit(1)) / group).alias("salts"))
    sliced = marked.join(counts, ["part", "band", "asking"]).withColumn("salt", F.pmod(F.xxhash64("node"), "salts"))
    slices = sliced.select("part", "band", "asking", "salt").distinct()
    # a table of slices; every two that may link are a cell
    asking, other = (slices.select("part", *[F.col(c).alias(f"{p}_{c}") for c in ("band", "asking", "salt")]) for p in ("a", "b"))
    pairs = asking.filter("a_asking").withColumn("b_band", F.explode(F.array(F.col("a_band") - 1, F.col("a_band"), F.col("a_band") + 1))).join(other, ["part", "b_band"])
    once = ~F.col("b_asking") | (F.struct("a_band", "a_salt") <= F.struct("b_band", "b_salt"))
    pairs = pairs.filter(once).withColumn("cell", F.xxhash64("part", "a_band", "a_salt", "b_band", "b_asking", "b_salt"))
    same = (F.col("a_band") == F.col("b_band")) & F.col("b_asking") & (F.col("a_salt") == F.col("b_salt"))
    ends = F.array(F.struct(F.col("a_band").alias("band"), F.lit(True).alias("asking"), F.col("a_salt").alias("salt"), F.when(same, 3).otherwise(1).alias("side")), F.when(~same, F.struct(F.col("b_band").alias("band"), F.col("b_asking").alias("asking"), F.col("b_salt").alias("salt"), F.lit(2).alias("side"))))
    wanted = pairs.select("part", "cell", F.explode(F.filter(ends, lambda x: x.isNotNull())).alias("e")).select("part", "cell", "e.*")
    return sliced.join(wanted, ["part", "band", "asking", "salt"]).select("cell", "node", "n", "shared", "side")


def class_links(sets: DataFrame, percent: int, group: int = GROUP) -> DataFrame:
    """Links (a, b) that connect what the links among sets (node, n, shared) connect."""
    rare = F.expr(f"cast(greatest(0, length(shared) div 8 - (n * {percent} + 99) div 100 + 1) as int)")
    keys = sets.select("node", F.explode(F.transform(F.sequence(F.lit(1), rare), lambda i: F.substring("shared", i * 8 - 7, F.lit(8)))).alias("key")).filter(F.length("key") == 8)
    stars = keys.groupBy("key").agg(F.min("node").alias("b"))
    near = keys.join(stars, "key").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    grouped = connected_components(near)
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    grouped = grouped.join(sizes, "component").withColumnsRenamed({"id": "node", "component": "part"})
    rows = materialize(sets.join(grouped, "node"))
    small = rows.filter(F.col("members") <= group)
    tasks = max(2 * sets.sparkSession.sparkContext.defaultParallelism, -(-small.count() // TASK_CLASSES))
    small = small.withColumn("task", F.pmod(F.xxhash64("part"), F.lit(8 * tasks))).repartition(tasks, "task")
    edges = [materialize(_linked(small.drop("members"), ["task"], percent))]
    large = rows.filter(F.col("members") > group)
    n_large = large.count()
    left, before = large, None
    while n_large and (before is None or n_large < before):
        cut = left.withColumn("slice", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / group)))
        edges.append(materialize(_linked(cut.select("part", "slice", "node", "n", "shared"), ["part", "slice"], percent)))
        labelled = _labelled(left, edges[-1])
        tops = labelled.filter("node = component").drop("component")
        count = tops.groupBy("part").agg(F.count(F.lit(1)).alias("members"))
        left = materialize(tops.drop("members").join(count, "part").filter("members > 1"))
        before, n_large = n_large, left.count()
    if n_large:  # what isn't in its group's largest component, against all of the group
        joined = edges[1]
        for e in edges[2:]:
            joined = joined.unionByName(e)
        edges.append(materialize(_linked(_cells(materialize(_labelled(large, joined)), percent, group), ["cell"], percent)))
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _joined(docs: DataFrame, columns: list[str], n: int, percent: int, group: int) -> tuple[DataFrame, DataFrame]:
    """The blocks of docs (doc_id, text and `columns`), and for each row doc_id, n_shingles, row, lead (the
    row that stands for its class), class_id and component, component_id (null without a doc_id)."""
    spark = docs.sparkSession
    blocks = text_blocks(docs, columns, "text")
    salts = fresh_salts()

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, documents, _ in each_block(batches, False):
            s = Shingles(documents, n, salts, twice=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (s.ids, s.size, row_key(block, np.arange(len(s.size))), *s.signs())], _SIGNS.names)

    signed = materialize(blocks.select("block", "payload").mapInArrow(signs, _SIGNS))
    # a class is led by its least doc_id; the row tells repeated ones apart
    leader = F.min(F.struct("doc_id", "row"))
    classes = materialize(signed.filter("n_shingles > 0").groupBy("sign", "sign2", "n_shingles").agg(leader.alias("lead")).select("sign", "sign2", "n_shingles", "lead.*"))
    size = total_bytes(blocks)
    counts = _Counts(n, percent, owners(spark, size // 6), salts)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [np.array(x, np.int32).tobytes() for x in batch.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array([-1] * len(places), pa.int32()), pa.array(places, pa.binary())], ["block", "owner", "reply"])

    named = classes.filter(F.col("doc_id") != NO_ID)
    block, place = F.shiftright("row", 16).alias("block"), F.col("row").bitwiseAND(F.lit(0xFFFF)).alias("place")
    leads = named.select(block, place).groupBy("block").agg(F.collect_list("place").alias("places")).mapInArrow(lists, "block long, owner int, reply binary")
    told = with_replies(blocks, ask(with_replies(blocks, leads), size, counts.request, counts.answer))

    def survive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, documents, replies in each_block(batches, True):
            rows = [(row_key(b, d), *more) for d, *more in counts.survivors(documents, replies)] if replies else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], _SETS.names)

    sets = materialize(told.select("block", "payload", "replies").mapInArrow(survive, _SETS), packed=True)
    components = connected_components(class_links(sets, percent, group)).withColumnRenamed("id", "row")
    known = materialize(classes.join(components, "row", "left").withColumn("component", F.coalesce("component", "row")))
    least = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = known.join(least, "component").select("sign", "sign2", "n_shingles", F.col("row").alias("lead"), F.col("doc_id").alias("class_id"), "component", "component_id")
    rows = signed.join(found, ["sign", "sign2", "n_shingles"], "left")
    none = lambda c: F.nullif(F.coalesce(c, "doc_id"), F.lit(NO_ID)).alias(c)
    return blocks, rows.select("doc_id", "n_shingles", "row", none("class_id"), "component", none("component_id"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, class_id (least doc_id with the same set) and component_id (least doc_id
    that links reach) of each document. Two documents link if their sets' Jaccard similarity is
    percent / 100 or more."""
    picked = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))
    _, rows = _joined(picked, ["doc_id", "text"], n, percent, group)
    return rows.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", "class_id", "component_id")


def first_of_each(docs: DataFrame, columns: list[str], n: int = N, percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """`columns` (doc_id and text among them) of one row of every component: the one of least doc_id, rows
    without one last. Rows without words are kept. Rows are told apart by their place, so two that share
    a doc_id but not a component both stay."""
    spark = docs.sparkSession
    picked = docs.select(*[F.coalesce(F.col(c).cast("long"), F.lit(NO_ID)).alias(c) if c == "doc_id" else F.col(c) for c in columns])
    blocks, rows = _joined(picked, columns, n, percent, group)
    first = rows.filter("n_shingles > 0").groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("f")).select("f.row")
    kept = first.unionByName(rows.filter("n_shingles = 0").select("row"))
    places = kept.select(F.shiftright("row", 16).alias("block"), F.col("row").bitwiseAND(F.lit(0xFFFF)).alias("place")).groupBy("block").agg(F.collect_list("place").alias("places"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in picked.select(*columns).schema])
    arrow = to_arrow_schema(schema)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, at in zip(batch.column("payload"), batch.column("places"), strict=True):
                yield from unpack(payload.as_py()).take(pa.array(sorted(at.as_py()), pa.int64())).cast(arrow).to_batches()

    found = blocks.select("block", "payload").join(places.hint("shuffle_hash"), "block").select("payload", "places").mapInArrow(pick, schema)
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID))).select(*columns)

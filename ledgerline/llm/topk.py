"""Exact top-k search by inner product: a ball tree for each shard, branch and bound.

Vectors become integers, floor(scale * x). The candidates are dealt to shards of bounded size,
each with a ball tree. Blocks of queries meet every shard. A node's score is at most q.c + |q| r
for its center c and radius r; nodes are visited from the largest bound down and skipped once
the bound is below the query's current k-th score. Every query searches its own pilot shard
first, and the k-th score found there is shared with the search of all other shards.

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter
vectors count as padded with zeros; equal scores go to the smaller id; equal vectors are
candidates each; ids that repeat are kept apart except that a query never meets its own id; components so
large that a score might not fit 64 bits are an error (ValueError), not a wrong score; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, materialize, pack_columns, unpack

#: Candidates in a shard, queries in a block, vectors in a leaf.
SHARD, BLOCK, LEAF = 8_192, 1_024, 256
_FOUND = "query_id long, vec_id long, score long"


def _matrix(table: pa.Table, width: int | None = None) -> np.ndarray:
    lists = table.column("v").combine_chunks()
    flat, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
    lengths = np.diff(offsets)
    width = width or int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], lengths)
    out[row, place] = flat[offsets[0] : offsets[-1]]
    return out


def ball_tree(v: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple[int, int, int, int]], np.ndarray, np.ndarray]:
    """Order of the vectors; nodes (first, last, left child, right child; 0 for none); centers, radii."""
    order, nodes, centers, radii = np.arange(len(v)), [], [], []
    open_ = [(0, len(v), -1, 0)]
    while open_:
        a, b, parent, side = open_.pop()
        some = v[order[a:b]].astype(float)
        center = some.mean(0)
        me = len(nodes)
        nodes.append([a, b, 0, 0])
        centers.append(center)
        radii.append(np.sqrt(((some - center) ** 2).sum(1).max()))
        if parent >= 0:
            nodes[parent][2 + side] = me
        if b - a > leaf and radii[-1] > 0:
            spread = some.max(0) - some.min(0)
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(some[:, int(spread.argmax())], middle)]
            open_ += [(a, a + middle, me, 0), (a + middle, b, me, 1)]
    return order, [tuple(n) for n in nodes], np.array(centers), np.array(radii)


def search(q: np.ndarray, q_ids: np.ndarray, kth: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, id, score) of the best k of each query among v, where the score reaches kth."""
    width = max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, v))
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * width < 2**52
    order, nodes, centers, radii = ball_tree(v)
    v, ids = v[order], ids[order]
    qf, vf = q.astype(float), v.astype(float)
    norms, kth = np.sqrt((qf**2).sum(1)), kth.astype(float).copy()
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    open_ = [(0, np.arange(len(q)))]
    slack = 1e-6
    while open_:
        node, active = open_.pop()
        a, b, left, right = nodes[node]
        bound = qf[active] @ centers[node] + norms[active] * radii[node]
        active = active[bound * (1 + slack * np.sign(bound)) + slack >= kth[active]]
        if not len(active):
            continue
        if left:
            # the child with the larger bounds comes first
            toward = [float(np.mean(qf[active] @ centers[c] + norms[active] * radii[c])) for c in (left, right)]
            near, far = (left, right) if toward[0] >= toward[1] else (right, left)
            open_ += [(far, active), (near, active)]
            continue
        score = (qf[active] @ vf[a:b].T).astype(np.int64) if exact else q[active] @ v[a:b].T
        row, at = np.nonzero((score >= kth[active][:, None]) & (ids[a:b][None, :] != q_ids[active][:, None]))
        if not len(row):
            continue
        new = (active[row], ids[a:b][at], score[row, at])
        touched = np.zeros(len(q), bool)
        touched[active[row]] = True
        mine = touched[best[0]]
        r, i, s = (np.concatenate([x[mine], y]) for x, y in zip(best, new, strict=True))
        by = np.lexsort((i, -s, r))
        r, i, s = r[by], i[by], s[by]
        starts = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        rank = np.arange(len(r)) - np.repeat(starts, np.diff(np.append(starts, len(r))))
        full = rank == k - 1
        kth[r[full]] = np.maximum(kth[r[full]], s[full])
        keep = rank < k
        best = tuple(np.concatenate([x[~mine], y[keep]]) for x, y in zip(best, (r, i, s), strict=True))
    return best


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query. Queries are the
    rows whose id is divisible by `every`; candidates are all rows but the query's own."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    usable = vectors.filter(x.isNotNull() & F.col(id_col).isNotNull() & ~bad).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))
    usable = materialize(usable.filter(F.size("v") >= 0))
    n, width, most = usable.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(F.array_max(F.transform("v", lambda e: F.abs(e.cast("double"))))), F.lit(0.0))).first()
    if most**2 * width >= 2**63:
        raise ValueError(f"{vector_col}: components up to {most / scale:g} in {width} places; scores might not fit 64 bits")
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-n // every // BLOCK))

    def packed(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        v = _matrix(group)
        data = pack_columns(id=column(group, "id"), **{f"v{j}": v[:, j] for j in range(v.shape[1])})
        return pa.table({"part": group.column("part")[:1], "payload": pa.array([data], pa.binary())})

    def pack_by(rows: DataFrame, parts: int) -> DataFrame:
        return materialize(rows.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")).groupBy("part").applyInArrow(packed, "part int, payload binary"), packed=True)

    shard_rows = pack_by(usable, shards).withColumnsRenamed({"part": "shard", "payload": "candidates"})
    query_rows = pack_by(usable.filter(f"id % {every} = 0"), blocks).withColumnsRenamed({"part": "block", "payload": "queries"})
    none = -(1 << 62)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for queries, candidates, ids, bounds in zip(*(batch.column(c) for c in ("queries", "candidates", "ids", "bounds")), strict=True):
                (q_ids, q), (v_ids, v) = ((column(t, "id"), np.stack([column(t, c) for c in t.column_names[1:]], 1) if t.num_columns > 1 else np.zeros((t.num_rows, 0), np.int64)) for t in (unpack(queries.as_py()), unpack(candidates.as_py())))
                known = dict(zip(ids.as_py() or (), bounds.as_py() or (), strict=True))
                kth = np.array([known.get(i, none) for i in q_ids.tolist()], np.int64)
                row, i, s = search(q, q_ids, kth, v, v_ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[row]), pa.array(i), pa.array(s)], ["query_id", "vec_id", "score"])

    pilot = query_rows.withColumn("shard", F.col("block") % shards)
    no_bounds = pilot.withColumns({"ids": F.lit(None).cast("array<long>"), "bounds": F.lit(None).cast("array<long>")})
    first = materialize(no_bounds.join(shard_rows, "shard").select("queries", "candidates", "ids", "bounds").mapInArrow(run, _FOUND))
    by_query = first.groupBy("query_id").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("found")).filter(F.col("found") >= k)
    where = usable.filter(f"id % {every} = 0").select(F.col("id").alias("query_id"), F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"))
    bounds = by_query.join(where, "query_id").groupBy("block").agg(F.collect_list("query_id").alias("ids"), F.collect_list("bound").alias("bounds"))
    rest = query_rows.join(bounds, "block", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(F.col("shard") != F.col("block") % shards)
    others = rest.repartition(F.col("block"), F.col("shard")).join(shard_rows, "shard").select("queries", "candidates", "ids", "bounds").mapInArrow(run, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(others).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

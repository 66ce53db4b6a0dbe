"""Shared helpers: tables in the shared folder, documents in blocks, questions about keys.

Several operators ask one question about very many small keys (hashes of windows, words):
which of them occur elsewhere, and what belongs to them? A row for each key and place would
cost far more than the key itself. The corpus is cut into blocks of bounded size instead, and
each block sends its distinct keys once, as packed arrays, to the partition that owns them. It
gets an answer of the same order back. A key that occurs millions of times costs one entry a
block, so frequent keys need no special treatment.

The blocks are a table bucketed by block: joining the answers to them moves the answers only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in a block; one longer document makes a block of its own.
BLOCK_BYTES = 1 << 20
#: Rows of a block at most, so that block and place fit in one number (see row_key).
BLOCK_ROWS = 1 << 16
#: Bytes of text for each task that answers questions.
TASK_BYTES = 32 << 20
#: Most buckets of a table of blocks (Spark's own limit is 100,000).
MAX_BUCKETS = 50_000


#: Folders made by the running applications, by application.
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset on a
    single machine (tests), a temporary folder; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir: names no folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_folder(spark: SparkSession) -> str:
    """A path of the shared folder for one intermediate table; `release` removes it."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def made_so_far(spark: SparkSession) -> int:
    """A mark for `release`."""
    return len(_made.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, since: int = 0, keep: list[str] | None = None) -> None:
    """Removes the intermediate tables made since a mark, but for `keep`. Frames that read them can't
    be used any more: write an operator's result first."""
    made = _made.get(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in made[since:]:
        if path not in (keep or ()):
            where = hadoop(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    made[since:] = [p for p in made[since:] if p in (keep or ())]


def materialize(df: DataFrame, packed: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it again. This cuts the lineage: a lost
    executor costs the tasks that it ran, not the stages before. packed: already compressed."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.option("compression", "none" if packed else "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, since: int) -> DataFrame:
    """materialize, then release all intermediate tables made since a mark but the new one."""
    out = materialize(df)
    spark = df.sparkSession
    release(spark, since, _made[spark.sparkContext.applicationId][-1:])
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(batch: pa.RecordBatch | pa.Table) -> bytes:
    """Arrow stream with zstd."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def pack_columns(**columns: np.ndarray) -> bytes:
    """Numpy arrays of one length as an Arrow stream."""
    return pack(pa.table(columns))


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def record(schema: pa.Schema, *columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Owner of a block's notes to itself.
NOTE = -1
#: Stands for a null id while an operator runs; sorts after all others.
NO_ID = (1 << 63) - 1

_BLOCK = pa.schema([("block", pa.int64()), ("n_rows", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary())])
_ASKED = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("keys", pa.binary())])


def text_blocks(docs: DataFrame, columns: list[str], text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents as rows (block, n_rows, n_bytes, payload) of a table in the shared folder,
    bucketed by block. Every document is in one block; a payload holds `columns` of some
    documents with up to block_bytes of text. Null text becomes empty text."""
    spark = docs.sparkSession

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []
        size = rows = 0

        def row() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()  # rows stay in one chunk
            return record(_BLOCK, [block], [whole.num_rows], [size], [pack(whole)])

        for batch in batches:
            lengths = np.asarray(pc.binary_length(batch.column(batch.schema.get_field_index(text))).cast(pa.int64()))
            ends, first = np.cumsum(lengths), 0
            while first < batch.num_rows:
                base = int(ends[first - 1]) if first else 0
                last = max(first if held else first + 1, int(np.searchsorted(ends, base + block_bytes - size, side="right")))
                last = min(last, first + BLOCK_ROWS - rows)
                if last > first:
                    held.append(batch.slice(first, last - first))
                    size += int(ends[last - 1]) - base
                    rows += last - first
                if last < batch.num_rows:
                    yield row()
                    block += 1
                    held, size, rows = [], 0, 0
                first = last
        if held:
            yield row()

    picked = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c == text else F.col(c) for c in columns])
    name = f"blocks_{uuid.uuid4().hex}"
    made = picked.mapInArrow(blocks, "block long, n_rows long, n_bytes long, payload binary")
    n = min(partitions(spark), MAX_BUCKETS)
    made.write.format("parquet").bucketBy(n, "block").option("compression", "none").option("path", new_folder(spark)).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and the frame knows them
    return found


def row_key(block, place):
    """One number for a row of a block."""
    return (block << 16) | place


def ask(blocks: DataFrame, size: int, request: Callable[..., Iterator[tuple[int, bytes]]], answer: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """One round of questions about `size` bytes of text. request(documents) of a block gives (owner, keys) pairs;
    answer(blocks, keys) of one owner gives an answer to each. Returns rows (block, owner, reply).
    If `blocks` has a column `replies` (earlier replies), request(documents, replies) is called.
    A pair with the owner NOTE is a block's note to itself, which comes back unchanged."""
    told = "replies" in blocks.columns
    spread = partitions(blocks.sparkSession)

    def ask_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, documents, replies in each_block(batches, told):
            pairs = list(request(documents, replies) if told else request(documents))
            if pairs:
                own = NOTE - (block ^ block >> 32) % spread
                yield record(_ASKED, [block] * len(pairs), [own if p[0] == NOTE else p[0] for p in pairs], [p[1] for p in pairs])

    def answer_all(group: pa.Table) -> pa.Table:
        if group.column("owner")[0].as_py() <= NOTE:
            return group.rename_columns(["block", "owner", "reply"])
        replies = answer(group.column("block").to_pylist(), group.column("keys").to_pylist())
        return pa.table({"block": group.column("block"), "owner": group.column("owner"), "reply": pa.array(replies, pa.binary())})

    asked = blocks.mapInArrow(ask_all, "block long, owner int, keys binary")
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    return asked.repartition(tasks, "owner").groupBy("owner").applyInArrow(answer_all, "block long, owner int, reply binary")


def each_block(batches: Iterator[pa.RecordBatch], told: bool) -> Iterator[tuple[int, pa.Table, dict[int, bytes] | None]]:
    """(block, documents, replies by owner) of batches of rows (block, payload, replies)."""
    for batch in batches:
        for i in range(batch.num_rows):
            replies = {max(r["owner"], NOTE): r["reply"] for r in batch.column("replies")[i].as_py() or ()} if told else None
            yield batch.column("block")[i].as_py(), unpack(batch.column("payload")[i].as_py()), replies


def with_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """blocks with all the replies that each got; only the replies are shuffled."""
    each = replies.groupBy("block").agg(F.collect_list(F.struct("owner", "reply")).alias("replies"))
    return blocks.join(each.hint("shuffle_hash"), "block", "left")


def owners(spark: SparkSession, keys: int, per_owner: int = 2_000_000) -> int:
    """How many owners share so many keys; what one of them holds stays bounded."""
    return max(partitions(spark), -(-keys // per_owner))


def total_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum("n_bytes")).first()[0] or 0


def shares(hashes: np.ndarray, n_owners: int) -> Iterator[tuple[int, slice]]:
    """The owners of hashes in ascending order, with the share of each. Owners hold ranges of hashes."""
    owner = ((hashes >> np.uint64(32)) * np.uint64(n_owners)) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else [0]
    return ((int(owner[a]), slice(int(a), int(b))) for a, b in zip(edges[:-1], edges[1:], strict=True))


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def repeated_in(kind: type, lanes: int = 1) -> Callable[[list[int], list[bytes]], list[bytes]]:
    """An owner's answer to distinct keys of one kind: which of them did several blocks send?"""

    def answer(blocks: list[int], asked: list[bytes]) -> list[bytes]:
        parts = [np.frombuffer(x, kind).reshape(-1, lanes) for x in asked]
        keys = np.concatenate(parts)
        order = np.lexsort(keys.T[::-1])
        same = (keys[order][1:] == keys[order][:-1]).all(1)
        twice = np.zeros(len(keys), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        return [bits(x) for x in np.split(twice, np.cumsum([len(p) for p in parts])[:-1])]

    return answer

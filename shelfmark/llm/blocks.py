"""Documents in blocks, and a census of keys over all blocks.

Some operators must learn which of very many small keys (word windows, shingles, lines) occur in
more than one place, and then act on the texts. Rows per key would be shuffled at several times
the size of the texts. Instead documents are written once, in input order, as blocks of about
BLOCK_BYTES of text: one row of the staged table holds all columns of some hundred rows, compressed.
Each block reports its distinct keys, sorted and cut into buckets by their leading bits; a bucket
is counted in one group; the counts go back to the blocks.

A key counts once per block and key, however many documents of the block hold it, so a key that
every document holds costs one entry per block. The number of buckets grows with the input, so a
bucket stays small. Blocks are numbered in the staged table itself: a task that runs again after a
loss reads the same blocks. Only whole blocks are ever in one task's memory.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfmark.session import fresh_dir, prepare

BLOCK_BYTES = 4 << 20
# Text bytes per bucket of a census.
BUCKET_BYTES = 8 << 20
BLOCK_SCHEMA = "block long, n_bytes long, n_rows long, rows binary"
KEY_SCHEMA = "block long, bucket int, keys binary, weights binary"
SEEN_SCHEMA = "block long, bucket int, seen binary"
PAIR = np.dtype([("a", "<u8"), ("b", "<u4")])


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of this package; Arrow batches bounded by rows and bytes."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Memory that Arrow and the C library keep after a task goes back to the system: workers live on and would hold it
    beside what the next stage needs."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes | memoryview) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all().combine_chunks()


def text_bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lengths = pc.binary_length(column)
    return pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def to_blocks(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows packed in blocks, staged."""
    ready(docs.sparkSession)
    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            lengths = text_bytes(batch.column(text)) + 64
            first = 0
            while first < batch.num_rows:
                reach = size + np.cumsum(lengths[first:])
                n = int(np.searchsorted(reach, limit)) + 1
                piece = batch.slice(first, n)
                held.append(piece)
                size = int(reach[piece.num_rows - 1])
                first += piece.num_rows
                if size >= limit:
                    yield one_block(at, held, size)
                    at, held, size = at + 1, [], 0
        if held:
            yield one_block(at, held, size)
        held = None
        give_back()

    def one_block(at: int, held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        return pa.RecordBatch.from_pydict(
            {"block": [at], "n_bytes": [size], "n_rows": [table.num_rows], "rows": [pack(table)]},
            schema=pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("n_rows", pa.int64()), ("rows", pa.binary())]),
        )

    return staged(docs.mapInArrow(run, BLOCK_SCHEMA), "blocks")


def bucket_bits(blocks: DataFrame) -> int:
    """Leading bits of a key that name its bucket; the number of buckets grows with the texts."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(3, int(total // BUCKET_BYTES).bit_length())


def distinct_keys(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys cut to bits + 32 leading bits: the distinct ones in order, where each h is, counts."""
    return np.unique(h >> np.uint64(64 - bits - 32), return_inverse=True, return_counts=True)


def key_rows(block: int, cut: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    """One row per bucket for the distinct keys of a block."""
    buckets = (cut >> np.uint64(32)).astype(np.int64)
    return _rows(block, buckets, cut.astype(np.uint32), counts, bits)


def hash_rows(block: int, h: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    """As key_rows, for whole hashes in rising order."""
    return _rows(block, (h >> np.uint64(64 - bits)).astype(np.int64), h, counts, bits)


def pair_rows(block: int, a: np.ndarray, b: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    """As key_rows, for keys of 96 bits sorted by (a, b)."""
    keys = np.empty(len(a), dtype=PAIR)
    keys["a"], keys["b"] = a, b
    return _rows(block, (a >> np.uint64(64 - bits)).astype(np.int64), keys, counts, bits)


def _rows(block: int, buckets: np.ndarray, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    edges = np.searchsorted(buckets, np.arange((1 << bits) + 1))
    weights = np.minimum(counts, 255).astype(np.uint8)
    full = np.flatnonzero(np.diff(edges))
    return pa.table(
        {
            "block": pa.array(np.full(len(full), block, dtype=np.int64)),
            "bucket": pa.array(full.astype(np.int32)),
            "keys": pa.array([keys[edges[k] : edges[k + 1]].tobytes() for k in full], pa.binary()),
            "weights": pa.array([weights[edges[k] : edges[k + 1]].tobytes() for k in full], pa.binary()),
        }
    )


def per_block(blocks: DataFrame, make: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    """`make` applied to every block, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column("block").to_pylist(), batch.column("rows"), strict=True):
                yield from make(block, unpack(rows.as_buffer())).to_batches()
        give_back()

    return blocks.select("block", "rows").mapInArrow(run, schema)


def census(keys: DataFrame, dtype: np.dtype = np.dtype("<u4")) -> DataFrame:
    """For every reported key its total weight over all blocks, 255 at most, in reported order."""

    def count(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), dtype=dtype) for x in table.column("keys")]
        sizes = np.array([len(x) for x in parts])
        flat = np.concatenate(parts)
        weights = np.frombuffer(b"".join(table.column("weights").to_pylist()), dtype=np.uint8).astype(np.int64)
        if dtype == PAIR:
            order = np.lexsort((flat["b"], flat["a"]))
            a, b = flat["a"][order], flat["b"][order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        else:
            order = np.argsort(flat, kind="stable")
            a = flat[order]
            new = np.append(True, a[1:] != a[:-1])
        totals = np.minimum(np.add.reduceat(weights[order], np.flatnonzero(new)), 255).astype(np.uint8)
        seen = np.empty(len(flat), dtype=np.uint8)
        seen[order] = totals[np.cumsum(new) - 1]
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "seen": pa.array([seen[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary()),
            }
        )

    return keys.groupBy("bucket").applyInArrow(count, SEEN_SCHEMA)


def seen_of(answers: pa.Table, column: str = "seen") -> np.ndarray:
    """The counts of one block, in the order of its distinct keys."""
    if answers.num_rows == 0:
        return np.zeros(0, dtype=np.uint8)
    order = np.argsort(answers.column("bucket").to_numpy())
    parts = answers.column(column).to_pylist()
    return np.frombuffer(b"".join(parts[k] for k in order), dtype=np.uint8)


def with_answers(
    blocks: DataFrame, answers: DataFrame, make: Callable[[int, pa.Table, pa.Table], pa.Table], schema
) -> DataFrame:
    """`make(block, its rows, its answers)` for every block; a block without answers gets none."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = make(left.column("block")[0].as_py(), unpack(left.column("rows")[0].as_buffer()), right)
        give_back()
        return made

    return blocks.select("block", "rows").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def result_schema(docs: DataFrame, results: str) -> T.StructType:
    """Columns of docs, but for those with a result's name, then the results."""
    added = T.StructType.fromDDL(results)
    names = {f.name.lower() for f in added}
    return T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema if f.name.lower() not in names] + list(added))


def result_table(rows: pa.Table, results: dict[str, pa.Array]) -> pa.Table:
    """The same for one block."""
    names = {name.lower() for name in results}
    kept = {n: rows.column(n) for n in rows.column_names if n.lower() not in names}
    return pa.table(kept | results)

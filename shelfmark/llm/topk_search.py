"""Exact top-k search by inner product over a bit-sliced index.

Components become integers floor(SCALE * x). A block of the index holds its vectors both as rows and as
bit slices: for every attribute and bit one bitmap over the rows of the block. For a query, slices
are added as numbers, all rows at once: each set bit of each query component adds the slices of its
attribute, shifted; a negative component adds their complement, which differs from the wanted sum by a
constant. Sums are kept as two bitmaps per bit (sum and carry) and resolved once. The COARSE lowest
slices of the attributes are left out; what they could add is bounded by the query alone.

Top rows are then selected from the most significant slice of the sums downward. That gives the k-th
largest coarse sum; rows within the bound of it are the boundary and get their exact score.

Vectors with components beyond LARGEST have too many bits for slices of 64-bit words. If there are any, scores are
bounded in doubles from both sides, and every row that may be among the best by these bounds gets its exact
score in integers of any length, so the result is exact for all finite components.

Blocks meet queries in groups: each (block, group) pair is one unit, so neither side has to fit a
task as a whole, and at most k rows per query leave a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.llm.blocks import ready, staged

SCALE = 256
BLOCK_ROWS = 1 << 13
GROUP_QUERIES = 1 << 10
# The largest component of the sliced index, so that sums stay within 64 bits.
LARGEST = 1 << 24
LONG = 1 << 63
COARSE = 2
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Components as doubles, rows of `dims`; shorter vectors end in zeros."""
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, column] = flat
    return out


def quantised(vectors: pa.Array, dims: int) -> np.ndarray:
    """Integers of each vector, within LARGEST."""
    return np.floor(matrix(vectors, dims) * SCALE).astype("<i4")


def whole(x: float) -> int:
    """floor(SCALE * x) of a finite number, exactly."""
    above, below = x.as_integer_ratio()
    return above * SCALE // below


class Wide:
    """Vectors of any finite components, their scores bounded in doubles and resolved in integers of any length."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.scaled, self.size = self.bounded(rows)

    @staticmethod
    def bounded(rows: np.ndarray) -> tuple[np.ndarray, float]:
        """The rows over the power of two at or above their largest component, and that power."""
        power = int(np.frexp(np.abs(rows).max(initial=0.0))[1])
        return np.ldexp(rows, -power), power

    def top(self, query: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """Rows that may be among the k best, and their exact scores."""
        q, power = self.bounded(query)
        # floors differ from SCALE * x by less than one; the rest is rounding, and what underflows
        about = self.scaled @ q
        unit, other = np.ldexp(1.0, min(1000, -self.size)) / SCALE, np.ldexp(1.0, min(1000, -power)) / SCALE
        sizes = np.abs(self.scaled), np.abs(q)
        error = (sizes[0] @ sizes[1]) * (len(q) + 8) * 2.0**-52 + len(q) * 2.0**-1000
        error += (sizes[0].sum(axis=1) + len(q) * unit) * other + unit * (sizes[1].sum() + len(q) * other)
        error *= 1 + 1e-6
        low, high = np.where(own, -np.inf, about - error), np.where(own, -np.inf, about + error)
        bound = np.partition(low, len(low) - k)[-k] if len(low) > k else -np.inf
        rows = np.flatnonzero((high >= bound) & ~own)
        exact = [whole(float(x)) for x in query]
        return rows, [sum(whole(float(x)) * y for x, y in zip(self.rows[r], exact, strict=True)) for r in rows]


def order_key(score: int) -> str:
    """Text that sorts as the numbers do."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):06d}{digits}"
    return f"0{999_999 - len(digits):06d}{digits.translate(NINES)}"


NINES = str.maketrans("0123456789", "9876543210")


class Slices:
    """Bit slices of the numbers of a block, raised by `low` so that none is negative."""

    def __init__(self, rows: np.ndarray, low: int, bits: int) -> None:
        self.rows, self.low, self.bits = rows, low, bits
        n, dims = rows.shape
        self.words = (n + 63) // 64
        padded = np.zeros((self.words * 64, dims), dtype=np.uint64)
        padded[:n] = (rows - low).astype(np.uint64)
        self.slices = np.empty((dims, bits, self.words), dtype=np.uint64)
        for b in range(bits):
            packed = np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
            self.slices[:, b] = np.ascontiguousarray(packed).view(np.uint64)
        self.valid = np.packbits(np.arange(self.words * 64) < n, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray, drop: int) -> tuple[np.ndarray, int]:
        """Slices of the coarse sums, lowest first, and by how much the exact sums may exceed them."""
        weights = np.abs(query)
        kept = self.bits - drop
        width = max(1, int(weights.sum() * ((1 << kept) - 1)).bit_length())
        total = np.zeros((width, self.words), dtype=np.uint64)
        carry = np.zeros((width, self.words), dtype=np.uint64)
        for j in np.flatnonzero(weights).tolist():
            number = self.slices[j, drop:]
            if query[j] < 0:
                number = ~number
            weight, t = int(weights[j]), 0
            while weight >> t:
                if weight >> t & 1:
                    s, c = total[t:], carry[t:]
                    one, two = s ^ c, s & c
                    low = one[:kept]
                    two[:kept] |= low & number[: len(low)]
                    low ^= number[: len(low)]
                    total[t:] = one
                    carry[t + 1 :] = two[:-1]
                    carry[t] = 0
                t += 1
        over = np.zeros(self.words, dtype=np.uint64)
        for b in range(width):
            s, c = total[b], carry[b]
            one, two = s ^ c, s & c
            total[b] = one ^ over
            over = two | (one & over)
        return total, int(weights.sum()) * ((1 << drop) - 1) >> drop

    def top(self, query: np.ndarray, own: np.ndarray, k: int, drop: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that hold the k best exact scores and all ties with them, and their scores."""
        sums, slack = self.sums(query, drop)
        allowed = self.valid & ~own
        if int(np.bitwise_count(allowed).sum()) > k:
            better, equal, bound = np.zeros_like(allowed), allowed.copy(), 0
            for b in range(len(sums) - 1, -1, -1):
                ones = equal & sums[b]
                count = int(np.bitwise_count(better | ones).sum())
                if count >= k:
                    equal, bound = ones, bound | 1 << b
                else:
                    better, equal = better | ones, equal & ~sums[b]
            allowed = allowed & self.at_least(sums, max(0, bound - slack - 1))
        rows = np.flatnonzero(np.unpackbits(allowed.view(np.uint8), bitorder="little"))
        return rows, self.rows[rows] @ query

    def at_least(self, sums: np.ndarray, bound: int) -> np.ndarray:
        more, equal = np.zeros(self.words, dtype=np.uint64), np.full(self.words, FULL)
        for b in range(len(sums) - 1, -1, -1):
            if bound >> b & 1:
                equal = equal & sums[b]
            else:
                more |= equal & sums[b]
                equal = equal & ~sums[b]
        return more | equal


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def topk_search(
    vectors: DataFrame, queries: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", drop: int = COARSE
) -> DataFrame:
    """The k highest scores of each query row among all rows with another id: query_id, rank, vec_id, score.

    `queries` says which rows are queries. Rows with a null id or vector, and vectors that hold a null or
    a component that is not finite, take no part. Missing components of shorter vectors count as 0. Ties go to
    the smaller id. Scores are exact for all finite components; one beyond a long ranks by its exact value and
    is returned as the nearest long. Rows that share an id are candidates each on their own, and one query, the
    first of their vectors in order. An empty table, or no query, gives no rows. Other columns are left out.
    """
    spark = ready(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("q"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    found = rows.agg(
        F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.max(F.size("v")).alias("dims"), F.count_if(F.col("q")).alias("n")
    ).first()
    result = "query_id long, vec_id long, score long, place string"
    if not found["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, found["dims"])
    low, high = min(0, whole(found["low"] or 0.0)), max(0, whole(found["high"] or 0.0))
    wide = max(-low, high) > LARGEST
    kind, read = ("<f8", matrix) if wide else ("<i4", quantised)
    bits = max(1, (high - low).bit_length())
    drop = min(drop, bits - 1)
    groups = -(-found["n"] // GROUP_QUERIES)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, values, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            ids.append(batch.column("id").to_numpy())
            values.append(read(batch.column("v"), dims))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block(at, ids, values)
                at, ids, values, size = at + 1, [], [], 0
        if size:
            yield block(at, ids, values)

    def block(at: int, ids: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
        n = sum(map(len, ids))
        return pa.RecordBatch.from_pydict(
            {"block": [at], "n": pa.array([n], pa.int64()), "ids": [np.concatenate(ids).tobytes()], "values": [np.concatenate(values).astype(kind).tobytes()]}
        )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [], [], [], []
        if left.num_rows and right.num_rows and wide:
            index, ids = Wide(_numbers(left, "values", kind).reshape(-1, dims)), _numbers(left, "ids", "<i8")
            for query, blob in zip(right.column("id").to_pylist(), right.column("v"), strict=True):
                places, scores = index.top(np.frombuffer(blob.as_buffer(), dtype=kind), ids == query, k)
                chosen = sorted(zip([-s for s in scores], ids[places].tolist(), strict=True))[:k]
                out[0].extend([query] * len(chosen))
                out[1].extend(v for _, v in chosen)
                out[2].extend(max(-LONG, min(LONG - 1, -s)) for s, _ in chosen)
                out[3].extend(order_key(-s) for s, _ in chosen)
        elif left.num_rows and right.num_rows:
            index = Slices(_numbers(left, "values", kind).reshape(-1, dims).astype(np.int64), low, bits)
            ids = _numbers(left, "ids", "<i8")
            for query, blob in zip(right.column("id").to_pylist(), right.column("v"), strict=True):
                v = np.frombuffer(blob.as_buffer(), dtype=kind).astype(np.int64)
                own = np.zeros(index.words * 64, dtype=bool)
                own[: len(ids)] = ids == query
                places, scores = index.top(v, np.packbits(own, bitorder="little").view(np.uint64), k, drop)
                chosen = best(ids[places], scores, k)
                out[0].extend([query] * len(chosen))
                out[1].extend(ids[places][chosen].tolist())
                out[2].extend(scores[chosen].tolist())
                out[3].extend([None] * len(chosen))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ("query_id", "vec_id", "score", "place")
        return pa.table({c: pa.array(x, t) for c, x, t in zip(names, out, kinds, strict=True)})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = read(batch.column("v"), dims).astype(kind)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "v": pa.array([x.tobytes() for x in values], pa.binary())})

    index = staged(rows.select("id", "v").mapInArrow(blocks, "block long, n long, ids binary, values binary"), "index")
    index = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).mapInArrow(packed, "id long, v binary")
    asked = asked.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    names = index.select(F.col("block").alias("of_block"), F.col("grp").alias("of_grp"))
    pairs = asked.join(names, F.col("grp") == F.col("of_grp")).select("of_block", "of_grp", "id", "v")
    near = index.groupBy("block", "grp").cogroup(pairs.groupBy("of_block", "of_grp")).applyInArrow(search, result)
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _numbers(table: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=dtype) for x in table.column(column)])

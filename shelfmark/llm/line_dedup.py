"""Line dedup: of a line that several documents hold, only the first document keeps it.

Each block reports a 64-bit hash per distinct line key. Hashes are dealt to segments by their
leading bits, and a segment runs them through two Bloom filters: one of hashes seen once, one of
hashes seen again when the first already had them. What the second filter knows is a suspected
repeat. Only suspected lines are shuffled as text, one row per block and key; there the smallest
and largest document of a key are found exactly, so wrong suspicions change nothing. A segment has
BITS_PER_KEY bits for each reported key in either filter, whatever the size of the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm import blocks as B

MIN_CHARS = 10
BITS_PER_KEY = 16
BLANKS = b" \t\n\x0b\x0c\r"
SUSPECTS = "block long, line binary, first_none boolean, first_id long, last_none boolean, last_id long"


def line_keys(text: bytes) -> list[bytes]:
    """Lines with A-Z lower-cased and outer blanks stripped."""
    return [line.strip(BLANKS) for line in text.lower().split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    n = len(key)
    return n >= least and (n >= 4 * least or len(key.decode()) >= least)


def texts_of(rows: pa.Table, text: str) -> list[bytes]:
    return [x or b"" for x in rows.column(text).cast(pa.binary()).to_pylist()]


def _holders(rows: pa.Table, id: str, text: str, least: int) -> dict[bytes, list]:
    """For each long key of a block its smallest and largest document, null ids last."""
    found: dict[bytes, list] = {}
    for doc, data in zip(rows.column(id).to_pylist(), texts_of(rows, text), strict=True):
        me = (doc is None, doc or 0)
        for key in set(line_keys(data)):
            if long_enough(key, least):
                ends = found.get(key)
                if ends is None:
                    found[key] = [me, me]
                elif me < ends[0]:
                    ends[0] = me
                elif me > ends[1]:
                    ends[1] = me
    return found


def _hashed(found: dict[bytes, list]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Keys by rising hash, their hashes, and whether the block has them in two documents."""
    keys = list(found)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))
    order = np.argsort(h, kind="stable")
    twice = np.array([found[k][0] != found[k][1] for k in keys], dtype=bool)
    return [keys[k] for k in order], h[order], twice[order]


class SeenTwice:
    """Two Bloom filters, of hashes seen once and of hashes seen again."""

    def __init__(self, n: int) -> None:
        size = 1 << max(10, (n * BITS_PER_KEY - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.once, self.again = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return h & self.mask, (h * np.uint64(0x9FB21C651E98DF25) >> np.uint64(20)) & self.mask

    def add(self, h: np.ndarray, twice: np.ndarray) -> None:
        """Distinct hashes of one block; `twice` marks those it has in two documents."""
        p, q = self.places(h)
        repeat = (self.once[p] & self.once[q]) | twice
        self.again[p[repeat]] = self.again[q[repeat]] = True
        self.once[p] = self.once[q] = True

    def suspected(self, h: np.ndarray) -> np.ndarray:
        p, q = self.places(h)
        return self.again[p] & self.again[q]


def _filter(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x.as_buffer(), dtype="<u8") for x in table.column("keys")]
    filters = SeenTwice(sum(map(len, parts)))
    for h, twice in zip(parts, table.column("weights").to_pylist(), strict=True):
        filters.add(h, np.frombuffer(twice, dtype=np.uint8) > 1)
    return pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "seen": pa.array([filters.suspected(h).astype(np.uint8).tobytes() for h in parts], pa.binary()),
        }
    )


def line_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Columns of docs with `n_lines`, `n_dropped` and `kept_text`, one row per input row.

    Null and empty texts are one empty line. Rows with equal ids are one document; rows with a null
    id are one document that comes after all others. Lines whose key is shorter than `min_chars`
    code points stay, and so do repeats inside the document that keeps a line. Columns of docs that bear
    a result's name are replaced by it.
    """
    blocks = B.to_blocks(docs, text)
    bits = B.bucket_bits(blocks)

    def report(block: int, rows: pa.Table) -> pa.Table:
        _, h, twice = _hashed(_holders(rows, id, text, min_chars))
        return B.hash_rows(block, h, 1 + twice, bits)

    def suspects(block: int, rows: pa.Table, answers: pa.Table) -> pa.Table:
        found = _holders(rows, id, text, min_chars)
        keys, _, _ = _hashed(found)
        keys = [keys[k] for k in np.flatnonzero(B.seen_of(answers))]
        ends = [(k, *found[k][0], *found[k][1]) for k in keys]
        columns = list(zip(*ends, strict=True)) or [()] * 5
        kinds = (pa.binary(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64())
        names = ("line", "first_none", "first_id", "last_none", "last_id")
        return pa.table(
            {"block": pa.array([block] * len(ends), pa.int64())}
            | {n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)}
        )

    def drop(block: int, rows: pa.Table, answers: pa.Table) -> pa.Table:
        keeper = dict(
            zip(
                answers.column("line").to_pylist(),
                zip(answers.column("none").to_pylist(), answers.column("id").to_pylist(), strict=True),
                strict=True,
            )
        )
        n_lines, n_dropped, kept = [], [], []
        for doc, data in zip(rows.column(id).to_pylist(), texts_of(rows, text), strict=True):
            me, lines = (doc is None, doc or 0), data.split(b"\n")
            stay = lines
            if keeper:
                stay = [a for a, k in zip(lines, line_keys(data), strict=True) if keeper.get(k, me) == me]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay))
        return B.result_table(
            rows,
            {
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            },
        )

    hashes = B.per_block(blocks, report, B.KEY_SCHEMA)
    seen = hashes.groupBy("bucket").applyInArrow(_filter, B.SEEN_SCHEMA)
    lines = B.staged(B.with_answers(blocks, seen, suspects, SUSPECTS), "suspects")
    ends = lines.groupBy("line").agg(
        F.min(F.struct("first_none", "first_id")).alias("first"), F.max(F.struct("last_none", "last_id")).alias("last")
    )
    confirmed = ends.where(
        (F.col("first.first_none") != F.col("last.last_none")) | (F.col("first.first_id") != F.col("last.last_id"))
    )
    answers = lines.select("block", "line").join(
        confirmed.select("line", F.col("first.first_none").alias("none"), F.col("first.first_id").alias("id")), "line"
    )
    return B.with_answers(
        blocks, answers, drop, B.result_schema(docs, "n_lines long, n_dropped long, kept_text string")
    )

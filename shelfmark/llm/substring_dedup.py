"""Substring dedup: drop words inside long word windows that start anywhere else too.

Hashing all windows of all texts costs a key per word. A difference cover D of the numbers modulo
a period p holds, for every distance, two members that far apart. So for any two places that hold
the same window of W words some offset below p takes both to positions that are in D modulo p. It is
enough to hash the W - p + 1 words at those positions, the anchors: every repeated window holds
an anchor that another place has as an anchor too.

1. Blocks report their distinct anchors; a census counts them.
2. Around anchors met twice every window of W words is a candidate. Candidates are hashed in full
   (96 bits beside the bucket) and counted in a second census.
3. Words under candidates counted twice go.

Decisions rest on the input alone. A passage held by every document is one entry per block.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm import blocks as B, words as W

WINDOW = 35
# Perfect difference sets by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least a third of the window."""
    period = max(p for p in COVERS if p == 1 or window - p + 1 >= max(1, window // 3))
    return period, COVERS[period]


class _Texts:
    """Words of one block."""

    def __init__(self, rows: pa.Table, text: str, window: int):
        self.buf, self.offsets = W.buffers(rows.column(text))
        self.starts, self.ends, self.firsts = W.spans(self.buf, self.offsets)
        self.h = W.word_hashes(self.buf, self.starts, self.ends)
        self.n = np.diff(self.firsts)
        self.window = window

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of every anchor; texts shorter than a window have none."""
        period, cover = cover_for(self.window)
        hashes, counts = W.windows(self.h, self.firsts, self.window - period + 1)
        inside = W.rows_of(np.zeros(len(counts), dtype=np.int64), counts)
        member = np.zeros(period, dtype=bool)
        member[list(cover)] = True
        taken = member[inside % period] & (np.repeat(self.n, counts) >= self.window)
        return hashes[taken], (np.repeat(self.firsts[:-1], counts) + inside)[taken]

    def candidates(self, places: np.ndarray) -> np.ndarray:
        """First words of all windows around the given anchors."""
        period, _ = cover_for(self.window)
        near = _runs(np.maximum(places - period + 1, 0), places + 1, len(self.h))
        starts = np.flatnonzero(near)
        doc = np.searchsorted(self.firsts, starts, "right") - 1
        return starts[starts + self.window <= self.firsts[doc + 1]]

    def full(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each whole window."""
        a = np.zeros(len(starts), dtype=np.uint64)
        b = np.zeros(len(starts), dtype=np.uint64)
        for j in range(self.window):
            h = self.h[starts + j]
            a = a * np.uint64(0xD6E8FEB86659FD93) + h
            b = b * np.uint64(0xA0761D6478BD642F) + (h >> np.uint64(17) | h << np.uint64(47))
        return W.mix(a), W.mix(b) & np.uint64(0xFFFFFFFF)

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """Words that lie in a window starting at one of `starts`."""
        return _runs(starts, starts + self.window, len(self.h))


def _runs(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the runs."""
    depth = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(depth[:n]) > 0


def _distinct_pairs(a: np.ndarray, b: np.ndarray):
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(a)]
    inverse = np.empty(len(a), dtype=np.int64)
    inverse[order] = np.cumsum(new) - 1
    return x[new], y[new], inverse, np.bincount(inverse, minlength=int(new.sum()))


def substring_dedup(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Columns of docs with `n_words`, `n_removed` and `kept_text`, one row per input row.

    Null and empty texts have no words and an empty kept text. Equal rows are different places, so
    texts of at least `window` words that occur twice lose everything. Columns of docs that bear a
    result's name are replaced by it.
    """
    blocks = B.to_blocks(docs, text)
    bits = B.bucket_bits(blocks)

    def report(block: int, rows: pa.Table) -> pa.Table:
        hashes, _ = _Texts(rows, text, window).anchors()
        cut, _, counts = B.distinct_keys(hashes, bits)
        return B.key_rows(block, cut, counts, bits)

    def candidates(texts: _Texts, answers: pa.Table):
        hashes, places = texts.anchors()
        _, inverse, _ = B.distinct_keys(hashes, bits)
        return texts.candidates(places[B.seen_of(answers)[inverse] > 1])

    def extend(block: int, rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _Texts(rows, text, window)
        a, b, _, counts = _distinct_pairs(*texts.full(candidates(texts, answers)))
        return B.pair_rows(block, a, b, counts, bits)

    def remove(block: int, rows: pa.Table, answers: pa.Table) -> pa.Table:
        step = answers.column("step").to_numpy()
        texts = _Texts(rows, text, window)
        starts = candidates(texts, answers.filter(pa.array(step == 1)))
        _, _, inverse, _ = _distinct_pairs(*texts.full(starts))
        gone = texts.covered(starts[B.seen_of(answers.filter(pa.array(step == 2)))[inverse] > 1])
        removed = np.diff(np.append(0, np.cumsum(gone))[texts.firsts])
        kept = []
        for k in range(rows.num_rows):
            found = texts.buf[texts.offsets[k] : texts.offsets[k + 1]].tobytes().split()
            if removed[k]:
                found = compress(found, (~gone[texts.firsts[k] : texts.firsts[k + 1]]).tolist())
            kept.append(b" ".join(found))
        return B.result_table(
            rows,
            {
                "n_words": pa.array(texts.n.astype(np.int64)),
                "n_removed": pa.array(removed.astype(np.int64)),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            },
        )

    first = B.staged(B.census(B.per_block(blocks, report, B.KEY_SCHEMA)), "anchors")
    second = B.census(B.with_answers(blocks, first, extend, B.KEY_SCHEMA), B.PAIR)
    answers = first.withColumn("step", F.lit(1)).unionByName(second.withColumn("step", F.lit(2)))
    return B.with_answers(
        blocks, answers, remove, B.result_schema(docs, "n_words long, n_removed long, kept_text string")
    )

"""Words and their hashes over whole buffers of texts, without one Python object per word.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return, and ends with its text. Hashes depend on the bytes of the word alone.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes hashed at once, and the longest word hashed by sums of powers.
SLICE = 1 << 20
ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value; powers of ODD, and of its inverse modulo 2^64."""
    letters = np.random.default_rng(20231).integers(0, 1 << 64, 256, dtype=np.uint64)
    n = 2 * SLICE + 1
    power, inverse = np.ones(n, dtype=np.uint64), np.ones(n, dtype=np.uint64)
    power[1:], inverse[1:] = np.uint64(ODD), np.uint64(pow(ODD, -1, 1 << 64))
    return letters, np.multiply.accumulate(power), np.multiply.accumulate(inverse)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(places) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[places[0] : places[-1]], places - places[0]


def spans(buf: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each text, one more at the end.

    `gaps` says for every byte whether it lies between words.
    """
    space = gaps[buf]
    edges = np.empty(len(buf) + 1, dtype=bool)
    edges[0] = True
    edges[1:] = space
    edges[offsets] = True
    starts = np.flatnonzero(~space & edges[:-1])
    edges[:-1] = space
    edges[-1] = True
    edges[offsets] = True
    ends = np.flatnonzero(~space & edges[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: sum of its bytes' random numbers times rising powers."""
    letters, power, inverse = _tables()
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + SLICE, "right")))
        last = int(ends[to - 1])
        if last - first > SLICE:  # one word longer than a slice
            out[at] = xxhash.xxh3_64_intdigest(buf[first:last].tobytes())
        else:
            sums = np.zeros(last - first + 1, dtype=np.uint64)
            np.cumsum(letters[buf[first:last]] * power[: last - first], out=sums[1:])
            begin = starts[at:to] - first
            out[at:to] = (sums[ends[at:to] - first] - sums[begin]) * inverse[begin]
        at = to
    return mix(out)


def windows(h: np.ndarray, firsts: np.ndarray, width: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each `width` consecutive words of one text, and how many windows each text has.

    Windows come text by text, in order.
    """
    counts = np.maximum(np.diff(firsts) - width + 1, 0)
    if len(h) < width:
        return np.zeros(0, dtype=np.uint64), counts
    base = np.uint64((ODD * (2 * seed + 1)) & MASK)
    total = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for j in range(width):
        total = total * base + h[j : len(h) - width + 1 + j]
    return mix(total[rows_of(firsts[:-1], counts)]), counts


def rows_of(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0] + 1, ... counts[0] numbers, then the same of the next."""
    whole = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(firsts - before, counts) + np.arange(whole)

"""Reproducible draws: uniform numbers from a hash of a seed and a row id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from shelfmark.functions.text import as_column

SPAN = 2**32


def uniform_int(seed: int, stream: str, row_id: Column | str) -> Column:
    """Whole number in [0, 2^32) fixed by seed, stream name and row id."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(stream), as_column(row_id).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def uniform_below(size: Column, seed: int, stream: str, row_id: Column | str) -> Column:
    """Whole number in [0, size); sizes beyond 2^32 take more digits of the hash."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(stream), as_column(row_id).cast("string"))
    wide = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.when(size <= SPAN, uniform_int(seed, stream, row_id)).otherwise(wide) % size


def uniform(seed: int, stream: str, row_id: Column | str) -> Column:
    return uniform_int(seed, stream, row_id) / F.lit(float(SPAN))


def cumulative(weights: Mapping[str, float]) -> list[tuple[str, float]]:
    """Keys with the running share of the total, which need not be one."""
    total, running, out = float(sum(weights.values())), 0.0, []
    for key, weight in weights.items():
        running += weight
        out.append((key, running / total))
    return out


def weighted_key(u: Column, weights: Mapping[str, float]) -> Column:
    """Key whose share of the weights covers the uniform number."""
    steps = cumulative(weights)
    chain = F.when(u < F.lit(steps[0][1]), F.lit(steps[0][0]))
    for key, bound in steps[1:-1]:
        chain = chain.when(u < F.lit(bound), F.lit(key))
    return chain.otherwise(F.lit(steps[-1][0]))


def from_set(h: Column, values: Sequence[int]) -> Column:
    """One of the values, by a whole-number draw."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (h % len(values) + 1).cast("int"))


def from_range(h: Column, low: int, high: int, step: int = 1) -> Column:
    """low, low + step, ... up to and including high at most."""
    count = (high - low) // step + 1
    return (F.lit(low) + (h % count) * step).cast("long")

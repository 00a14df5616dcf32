"""Per-group and global top-k.

`row_number() <= k` lets Spark cut every group to k rows in each input
partition before the exchange, so a hot group arrives as k rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    rank: str | None = None,
) -> DataFrame:
    name = rank or "_rank"
    ranked = df.withColumn(
        name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    return top_per_group(df, keys, order, 1)


def sample_per_group(
    df: DataFrame, keys: Sequence[str], row_id: Sequence[str], n: int, seed: int
) -> DataFrame:
    """min(n, size) rows of each group, drawn by a hash of the seed and row id."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in row_id]))
    return top_per_group(df, keys, [draw, *row_id], n)


def top_k(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)

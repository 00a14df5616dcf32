"""Joins, group totals and first rows that stay even when one key holds much of the data.

Joins leave hot keys to Spark, which splits them by their measured size. For group totals and first
rows, rows get a salt from their own columns, so a hot key falls into many (key, salt) groups. No
key list has to be known or collected.

Keys travel as one struct, in which null keys are equal, and a struct serves as
partitioning for a window or aggregate and the join after it alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.session import fits_broadcast, parallelism, unpacked_bytes

KEY = "_key"
# Unpacked input for each partition of `spread`, and the size from which on Catalyst's figure means "unknown".
PART_BYTES, UNKNOWN_BYTES = 32 << 20, 1 << 55


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys meet; keeps the left key columns."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def spread(df: DataFrame, *by: str, part_bytes: int = PART_BYTES, least: int = 2) -> DataFrame:
    """Rows dealt by the columns to partitions whose number grows with the input, not with the session's setting.

    An aggregate by these columns then holds one such part in memory; without it, a task holds the groups of a whole
    split of a file, or of what run-time coalescing puts together, which for narrow rows are many millions.
    """
    total = unpacked_bytes(df._jdf.queryExecution().optimizedPlan())
    n = parallelism(df.sparkSession) if total >= UNKNOWN_BYTES else max(least, -(-total // part_bytes))
    return df.repartition(n, *by)


def keyed(df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Key columns, and more parts, moved into one struct column."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(F.struct(*keys, *more).alias(KEY), *rest)


def unkeyed(columns: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """The given columns, those in the key struct taken from there."""
    return [F.col(KEY).getField(c).alias(c) if c in keys else F.col(c) for c in columns]


def salt(df: DataFrame, spread_by: Sequence[str], salts: int | None = None) -> Column:
    n = salts or parallelism(df.sparkSession)
    return F.pmod(F.xxhash64(*spread_by), F.lit(n)).cast("int").alias("_salt")


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join `left` to `right` (at most one row per key), null keys included.

    Both sides are read once. A right side that is small for sure may be broadcast by Spark; any other is
    merged, and Spark splits hot keys of the left side at run time (`forceOptimizeSkewedJoin`).
    """
    return null_safe_join(left, right if fits_broadcast(right) else right.hint("merge"), on, how)


def with_group_value(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, tuple[Column, str]],
    spread_by: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """Attach per-group aggregates to every row of the group.

    `values` maps a new column to (aggregate, merge), merge being the name of
    the function that combines partial results: "min", "max" or "sum". Only the
    partial results of a group, at most one per salt, ever meet in one task.
    """
    rows = keyed(df, keys, salt(df, spread_by, salts))
    partial = rows.groupBy(KEY).agg(*[a.alias(n) for n, (a, _) in values.items()])
    group = Window.partitionBy(*[F.col(KEY).getField(k) for k in keys])
    merge = {"min": F.min, "max": F.max, "sum": F.sum}
    totals = partial.select(
        KEY, *[merge[m](n).over(group).alias(n) for n, (_, m) in values.items()]
    )
    return rows.join(totals, KEY).select(*unkeyed([*df.columns, *values], keys))


def mark_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    among: Column,
    flag: str,
    salts: int | None = None,
) -> DataFrame:
    """Flag the first row of each key in order, among the rows that qualify.

    A row that is not first in its (key, salt) group cannot be first in its key.
    Only the others, at most one per salt, are ordered over the whole key.
    """
    rows = df.withColumn("_among", F.coalesce(among, F.lit(False)))
    rows = rows.withColumn("_salt", salt(df, order, salts))
    inside = Window.partitionBy(*keys, "_salt", "_among").orderBy(*order)
    placed = rows.withColumn("_place", F.row_number().over(inside))
    leads = F.col("_among") & (F.col("_place") == 1)
    whole = Window.partitionBy(*keys).orderBy(*order)
    output = [*df.columns, flag]
    others = placed.where(~leads).withColumn(flag, F.lit(False)).select(*output)
    leaders = placed.where(leads).withColumn(flag, F.row_number().over(whole) == 1)
    return others.unionByName(leaders.select(*output))

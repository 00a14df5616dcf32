"""Dominant classes and labels of attribute predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import as_column

# Fixed value: label of a missing prediction.
NO_PREDICTION = "No prediction"


def dominant_key(scores: Column | str) -> Column:
    """Key of the highest score in a map; the smallest key on a tie."""
    entries = F.map_entries(as_column(scores))
    ranked = F.transform(entries, lambda e: F.struct(-e["value"], e["key"].alias("key")))
    return F.array_min(ranked)["key"]


def dominant_category(df: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """Most frequent category of each group, smallest on a tie, with its count."""
    counts = df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col(category).alias("key")))
    return counts.groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.col("_b.key").alias(category), (-F.col("_b.minus")).alias("n")
    )


def prediction_label(
    gender: Column | str, age: Column | str, emotion: Column | str, race: Column | str
) -> Column:
    """"<gender>, <age> yrs\\n<emotion>, <race>"; "No prediction" when one is missing.

    Ages round to the nearest whole year, halves to the even one.
    """
    years = F.rint(as_column(age)).cast("long").cast("string")
    label = F.concat(
        as_column(gender), F.lit(", "), years, F.lit(" yrs\n"), as_column(emotion), F.lit(", "),
        as_column(race),
    )
    return F.coalesce(label, F.lit(NO_PREDICTION))

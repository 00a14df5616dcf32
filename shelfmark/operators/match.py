"""Tolerance match: the first stored row within a tolerance in every dimension.

Points are gathered into grid cells and compared cell by cell. Two cells that
lie wholly within the tolerance of each other need one number, the first stored
row of the one; two that lie wholly outside it need nothing. Of the pairs in
between, those whose stored cell cannot beat what the probe cell already has
are dropped, small ones are compared point by point, and large ones are split
into cells of half the width and judged again. So no cell, however full, has
all its pairs listed, and every probe still gets its exact first match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.operators.skew import skew_join
from shelfmark.session import cut_lineage

# Point pairs that two cells may have before they are split further.
SMALL_PAIR = 10_000
# Cells this fine hold one value of a dimension; they are compared as they are.
FINEST = 40


def _cell(dims: Mapping[str, float], level: int) -> Column:
    """Grid cell at a level; a cell of one level lies in one cell of the level above."""
    scale = F.lit(float(2**level))
    return F.struct(
        *[F.floor(F.col(d) / F.lit(float(t)) * scale).alias(d) for d, t in dims.items()]
    )


def _boxes(dims: Mapping[str, float], side: str) -> list[Column]:
    ends = (("lo", F.min), ("hi", F.max))
    return [pick(d).alias(f"_{side}_{name}_{d}") for d in dims for name, pick in ends]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _judge(pairs: DataFrame, keys: list[str], dims: Mapping[str, float]) -> DataFrame:
    """Pairs not out of reach, with what their probe cell is known to match.

    `_known` comes in as the parent cell's and goes out with the first rows of
    the cells wholly within reach; `_one` marks one pair per probe cell.
    """

    def side(s: str, end: str, d: str) -> Column:
        return F.col(f"_{s}_{end}_{d}")

    widest = {d: F.greatest(side("a", "hi", d) - side("b", "lo", d), side("b", "hi", d) - side("a", "lo", d)) for d in dims}
    nearest = {d: F.greatest(side("a", "lo", d) - side("b", "hi", d), side("b", "lo", d) - side("a", "hi", d)) for d in dims}
    inside = _all([widest[d] < F.lit(t) for d, t in dims.items()])
    reach = _all([nearest[d] < F.lit(t) for d, t in dims.items()])
    cell = Window.partitionBy(*keys, "_a")
    return (
        pairs.where(reach)
        .withColumn("_inside", inside)
        .select(
            *keys, "_a", "_b", "_n", "_m", "_f", "_inside",
            F.least("_known", F.min(F.when(F.col("_inside"), F.col("_f"))).over(cell)).alias("_known"),
            (F.row_number().over(cell.orderBy("_b")) == 1).alias("_one"),
        )
    )


def first_band_match(
    probes: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    dims: Mapping[str, float],
    order: Sequence[str],
    payload: Sequence[Column | str],
    probe_id: Sequence[str],
    earlier_than: Sequence[str] | None = None,
    small_pair: int = SMALL_PAIR,
) -> DataFrame:
    """Probes with `match`, a struct of the order and payload of the first stored
    row whose `dims` all differ from the probe's by less than their tolerance.

    Copies of a point are one row throughout. With `earlier_than`, a match must
    come before the probe's own values of those columns, which must be of the
    types of `order`. Null keys and null dimensions match nothing.
    """
    keys, names = list(keys), list(dims)
    complete = _all([F.col(c).isNotNull() for c in [*keys, *names]])
    points = probes.where(complete).select(*keys, *names).distinct()
    kept = (
        stored.where(complete)
        .groupBy(*keys, *names)
        .agg(F.min(F.struct(*order, *payload)).alias("_first"))
    )

    probe_cells = points.groupBy(*keys, _cell(dims, 0).alias("_a")).agg(
        F.count(F.lit(1)).alias("_n"), *_boxes(dims, "a")
    )
    stored_cells = kept.groupBy(*keys, _cell(dims, 0).alias("_b")).agg(
        F.count(F.lit(1)).alias("_m"), F.min("_first").alias("_f"), *_boxes(dims, "b")
    )
    offsets = [F.struct(*[F.lit(v).alias(d) for d, v in zip(names, o)])
               for o in product((-1, 0, 1), repeat=len(names))]
    around = F.struct(
        *[(F.col("_a").getField(d) + F.col("_o").getField(d)).alias(d) for d in names]
    )
    pairs = (
        probe_cells.withColumn("_o", F.explode(F.array(*offsets)))
        .withColumn("_b", around)
        .drop("_o")
        .join(stored_cells, [*keys, "_b"])
        .withColumn("_known", F.lit(None).cast(stored_cells.schema["_f"].dataType))
    )

    found = []
    for level in range(FINEST + 1):
        judged = cut_lineage(_judge(pairs, keys, dims))
        open_pairs = judged.where(
            ~F.col("_inside") & (F.col("_known").isNull() | (F.col("_f") < F.col("_known")))
        )
        is_small = F.col("_n") * F.col("_m") <= small_pair
        if level == FINEST:
            is_small = F.lit(True)
        placed = points.withColumn("_a", _cell(dims, level))

        known = judged.where(F.col("_one") & F.col("_known").isNotNull())
        found.append(
            placed.join(known.select(*keys, "_a", "_known"), [*keys, "_a"]).select(
                *keys, *names, F.col("_known").alias("match")
            )
        )
        others = kept.select(
            *keys, *[F.col(d).alias(f"_s_{d}") for d in names], "_first",
            _cell(dims, level).alias("_b"),
        )
        near = _all([F.abs(F.col(d) - F.col(f"_s_{d}")) < F.lit(t) for d, t in dims.items()])
        found.append(
            open_pairs.where(is_small)
            .select(*keys, "_a", "_b")
            .join(others, [*keys, "_b"])
            .join(placed, [*keys, "_a"])
            .where(near)
            .groupBy(*keys, *names)
            .agg(F.min("_first").alias("match"))
        )

        large = open_pairs.where(~is_small)
        if large.isEmpty():
            break
        # Only the points of large pairs go on, in cells of half the width.
        points = cut_lineage(
            placed.join(large.select(*keys, "_a"), [*keys, "_a"], "left_semi").select(*keys, *names)
        )
        kept = cut_lineage(
            kept.withColumn("_b", _cell(dims, level))
            .join(large.select(*keys, "_b"), [*keys, "_b"], "left_semi")
            .select(*keys, *names, "_first")
        )
        parent, child = _cell(dims, level), _cell(dims, level + 1)
        probe_cells = points.groupBy(*keys, parent.alias("_pa"), child.alias("_a")).agg(
            F.count(F.lit(1)).alias("_n"), *_boxes(dims, "a")
        )
        stored_cells = kept.groupBy(*keys, parent.alias("_pb"), child.alias("_b")).agg(
            F.count(F.lit(1)).alias("_m"), F.min("_first").alias("_f"), *_boxes(dims, "b")
        )
        pairs = (
            large.select(*keys, F.col("_a").alias("_pa"), F.col("_b").alias("_pb"), "_known")
            .join(probe_cells, [*keys, "_pa"])
            .join(stored_cells, [*keys, "_pb"])
            .drop("_pa", "_pb")
        )

    best = reduce(DataFrame.unionByName, found).groupBy(*keys, *names).agg(
        F.min("match").alias("match")
    )
    matched = skew_join(probes, best, [*keys, *names])
    if earlier_than:
        mine = F.struct(*earlier_than)
        theirs = F.struct(
            *[F.col("match").getField(o).alias(e) for o, e in zip(order, earlier_than)]
        )
        matched = matched.withColumn("match", F.when(theirs < mine, F.col("match")))
    return matched

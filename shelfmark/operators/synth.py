"""Synthetic columns drawn reproducibly for each row from a seed and its id.

A draw depends on nothing but the seed, the stream name and the row id, so rows
are independent, any partitioning gives the same result, and lost partitions
recompute to the same values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.draws import (
    from_range,
    from_set,
    uniform,
    uniform_below,
    uniform_int,
    weighted_key,
)
from shelfmark.operators.ordered import numbered, shifted
from shelfmark.operators.skew import skew_join

# Default generation settings.
CATEGORY_WEIGHTS = {
    "alu_logic": 0.38,
    "load": 0.22,
    "store": 0.12,
    "branch": 0.16,
    "jump": 0.02,
    "upper": 0.03,
    "system": 0.01,
    "pseudo_nop": 0.01,
    "fence": 0.005,
    "ecall_ebreak": 0.005,
}
ARITH_WEIGHTS = {
    "small": 0.25,
    "boundary": 0.05,
    "medium": 0.20,
    "random_full": 0.40,
    "special_pattern": 0.10,
}
ARITH_SMALL = [-1, 0, 1]
ARITH_BOUNDARY = [2047, -2048]
ARITH_SPECIAL = [255, 240, 2048, 2047]
OFFSET_WEIGHTS = {"near_zero": 0.15, "small_range": 0.60, "mid_range": 0.20, "far_range": 0.05}
OFFSET_LIMITS = {"small_range": (4, 64), "mid_range": (64, 256), "far_range": (256, 1024)}
SYMBOLIC_FRACTION = 0.60
SYMBOLIC_BASES = [4096, 65536, 1048576]
RAW_PROBABILITY = 0.40
WAW_PROBABILITY = 0.15
LOAD_USE_PROBABILITY = 0.30


def weighted_category(
    row_id: str, seed: int, weights: Mapping[str, float] = CATEGORY_WEIGHTS
) -> Column:
    return weighted_key(uniform(seed, "category", row_id), weights)


def mixture(row_id: str, seed: int, stream: str, rules: Mapping[str, Mapping]) -> Column:
    """A bucket by weight, then a value by the bucket's rule.

    Each rule has `weight` and one of `value` (a number), `set` (numbers) or `range` (lowest, highest and
    optionally step). Settings read from JSON have this form. Buckets without weight are never drawn.
    """
    bucket = weighted_key(uniform(seed, stream, row_id), {name: rule["weight"] for name, rule in rules.items()})
    h = uniform_int(seed, f"{stream} value", row_id)
    value = F.lit(None).cast("long")
    for name, rule in rules.items():
        if rule.get("value") is not None:
            own = F.lit(rule["value"])
        elif rule.get("set") is not None:
            own = from_set(h, rule["set"])
        else:
            own = from_range(h, *rule["range"])
        value = F.when(bucket == name, own.cast("long")).otherwise(value)
    return value


def mixture_rules(settings: DataFrame, field: str) -> dict[str, dict]:
    """Rules of one mixture from read settings: one row, a struct of structs."""
    return {name: {k: v for k, v in rule.items() if v is not None} for name, rule in settings.first()[field].asDict(True).items()}


ARITH_RULES = {
    "small": {"weight": ARITH_WEIGHTS["small"], "set": ARITH_SMALL},
    "boundary": {"weight": ARITH_WEIGHTS["boundary"], "set": ARITH_BOUNDARY},
    "medium": {"weight": ARITH_WEIGHTS["medium"], "range": [-32, 32]},
    "random_full": {"weight": ARITH_WEIGHTS["random_full"], "range": [-2048, 2047]},
    "special_pattern": {"weight": ARITH_WEIGHTS["special_pattern"], "set": ARITH_SPECIAL},
}
OFFSET_RULES = {"near_zero": {"weight": OFFSET_WEIGHTS["near_zero"], "value": 0}} | {
    name: {"weight": OFFSET_WEIGHTS[name], "range": [low, limit - 1, 4]} for name, (low, limit) in OFFSET_LIMITS.items()
}


def arithmetic_value(row_id: str, seed: int, rules: Mapping[str, Mapping] = ARITH_RULES) -> Column:
    return mixture(row_id, seed, "arith", rules)


def memory_offset(row_id: str, seed: int, rules: Mapping[str, Mapping] = OFFSET_RULES) -> Column:
    """Offset in steps of four, below the limit of its distance bucket."""
    return mixture(row_id, seed, "offset", rules)


def upper_value(
    row_id: str, seed: int, bases: Sequence[int] = SYMBOLIC_BASES, fraction: float = SYMBOLIC_FRACTION
) -> Column:
    """Upper 20 bits: of a symbolic base, or uniform."""
    h = uniform_int(seed, "upper value", row_id)
    base = F.shiftright(from_set(h, bases), 12).cast("long")
    symbolic = uniform(seed, "upper", row_id) < F.lit(fraction)
    return F.when(symbolic, base).otherwise(from_range(h, 0, 2**20 - 1))


def pick_members(
    requests: DataFrame,
    members: DataFrame,
    category: str,
    member: str,
    row_id: Sequence[str],
    seed: int,
    default: str,
    member_block: Column,
) -> DataFrame:
    """A uniformly chosen member of each request's category, else the default.

    Members are numbered within their category block by block, and a request
    looks its number up by (category, number). No category's members meet in
    one row or task.
    """
    places = numbered(members, [category], [member], member_block, "_place")
    sizes = members.groupBy(category).agg(F.count(F.lit(1)).alias("_size"))
    asked = skew_join(requests, sizes, [category])
    whole_id = F.concat_ws(":", *[F.col(c).cast("string") for c in row_id])
    place = uniform_below(F.col("_size"), seed, "member", whole_id) + 1
    asked = asked.withColumn("_place", place)
    found = skew_join(
        asked, places.select(category, "_place", F.col(member).alias("_m")),
        [category, "_place"],
    )
    return found.select(
        *requests.columns, F.coalesce(F.col("_m").cast("string"), F.lit(default)).alias(member)
    )


def dependent_draw(
    rows: DataFrame,
    run: Sequence[str],
    order: Sequence[str],
    block: Column,
    row_id: str,
    seed: int,
    load_type: str = "load",
    raw: float = RAW_PROBABILITY,
    waw: float = WAW_PROBABILITY,
    load_use: float = LOAD_USE_PROBABILITY,
) -> DataFrame:
    """Copy registers from the row before with given probabilities.

    Copies come from the base values of the row before, so that rows stay
    independent: a copied target does not travel further down the run.
    """
    before = shifted(
        rows, run, order, block, {"_rd": (F.col("rd"), 1), "_type": (F.col("type"), 1)}
    )
    writes = F.col("_rd").isNotNull() & (F.col("_rd") != 0)
    takes_raw = writes & (uniform(seed, "raw", row_id) < F.lit(raw))
    takes_waw = (
        F.col("_rd").isNotNull()
        & F.col("rd").isNotNull()
        & (uniform(seed, "waw", row_id) < F.lit(waw))
    )
    takes_load = (
        (F.col("_type") == F.lit(load_type))
        & F.col("_rd").isNotNull()
        & F.col("rs1").isNotNull()
        & (uniform(seed, "load use", row_id) < F.lit(load_use))
    )
    has_rs1 = F.col("rs1").isNotNull()
    rs1 = F.when(takes_load | (takes_raw & has_rs1), F.col("_rd")).otherwise(F.col("rs1"))
    rs2 = F.when(
        takes_raw & ~has_rs1 & F.col("rs2").isNotNull(), F.col("_rd")
    ).otherwise(F.col("rs2"))
    rd = F.when(takes_waw, F.col("_rd")).otherwise(F.col("rd"))
    others = [c for c in rows.columns if c not in ("rd", "rs1", "rs2")]
    return before.select(*others, rd.alias("rd"), rs1.alias("rs1"), rs2.alias("rs2"))

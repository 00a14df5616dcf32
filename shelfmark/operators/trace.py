"""Execution-trace figures and dependencies between adjacent instructions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import as_column
from shelfmark.operators.ordered import shifted

CYCLES = [
    "issued_cycle",
    "exec_start_cycle",
    "exec_complete_cycle",
    "write_result_cycle",
    "commit_cycle",
]


def ratio(part: Column, whole: Column, places: int, scale: int = 1) -> Column:
    """part * scale / whole, rounded half up on the exact quotient; null if whole = 0."""
    ten = 10**places
    units = F.floor(
        F.try_divide(2 * part * scale * ten + whole, (2 * whole).cast("decimal(20,0)"))
    )
    return F.when(whole > 0, units.cast("long") / F.lit(float(ten)))


def run_kpis(trace: DataFrame, run: Sequence[str], branch_type: str = "branch") -> DataFrame:
    """Per run: issued, committed, cycles, IPC, CPI and branch prediction rates.

    Rates default as in the statistics panel: IPC and misprediction rate 0, CPI
    and accuracy null (shown as "N/A").
    """
    present = [c for c in CYCLES if c in trace.columns]
    last = F.greatest(*[F.col(c) for c in present]) if len(present) > 1 else F.col(present[0])
    is_branch = F.col("type") == F.lit(branch_type)
    counted = trace.groupBy(*run).agg(
        F.count(F.lit(1)).alias("issued"),
        F.count_if(F.col("commit_cycle").isNotNull() & ~F.col("flushed")).alias("committed"),
        F.coalesce(F.max(last), F.lit(0)).cast("long").alias("cycles"),
        F.count_if(is_branch).alias("branches"),
        F.count_if(is_branch & F.col("mispredicted")).alias("mispredictions"),
    )
    committed, cycles = F.col("committed"), F.col("cycles")
    branches, wrong = F.col("branches"), F.col("mispredictions")
    return counted.select(
        "*",
        F.coalesce(F.when(committed > 0, ratio(committed, cycles, 3)), F.lit(0.0)).alias("ipc"),
        ratio(cycles, committed, 3).alias("cpi"),
        ratio(branches - wrong, branches, 2, 100).alias("branch_accuracy"),
        F.coalesce(ratio(wrong, branches, 2, 100), F.lit(0.0)).alias("misprediction_rate"),
    )


def or_na(c: Column | str, places: int) -> Column:
    """Number as fixed-point text, "N/A" for null."""
    c = as_column(c)
    return F.when(c.isNotNull(), F.format_string(f"%.{places}f", c)).otherwise(F.lit("N/A"))


def adjacent_dependencies(
    rows: DataFrame,
    run: Sequence[str],
    order: Sequence[str],
    block: Column,
    load_type: str = "load",
) -> DataFrame:
    """Flag what each instruction takes from the one or two before it.

    `raw_rs1`/`raw_rs2` give the distance (1 before 2, 0 for none) of the nearest
    earlier writer of that source register, register 0 never counting. `waw`:
    same target as the row before. `load_use`: a source is the target of a load
    in the row before.
    """
    before = shifted(
        rows,
        run,
        order,
        block,
        {"_rd1": (F.col("rd"), 1), "_rd2": (F.col("rd"), 2), "_type1": (F.col("type"), 1)},
    )

    def feeds(earlier: str, source: str) -> Column:
        return F.coalesce(
            (F.col(earlier) != 0) & (F.col(earlier) == F.col(source)), F.lit(False)
        )

    def distance(source: str) -> Column:
        return F.when(feeds("_rd1", source), 1).when(feeds("_rd2", source), 2).otherwise(0)

    load = F.coalesce(F.col("_type1") == F.lit(load_type), F.lit(False))
    return before.select(
        *rows.columns,
        distance("rs1").alias("raw_rs1"),
        distance("rs2").alias("raw_rs2"),
        F.coalesce(F.col("_rd1") == F.col("rd"), F.lit(False)).alias("waw"),
        (load & (feeds("_rd1", "rs1") | feeds("_rd1", "rs2"))).alias("load_use"),
    )


def dependency_counts(flagged: DataFrame, run: Sequence[str]) -> DataFrame:
    one = (F.col("raw_rs1") == 1) | (F.col("raw_rs2") == 1)
    two = (F.col("raw_rs1") == 2) | (F.col("raw_rs2") == 2)
    return flagged.groupBy(*run).agg(
        F.count_if(one).alias("raw_distance_1"),
        F.count_if(two).alias("raw_distance_2"),
        F.count_if("waw").alias("waw"),
        F.count_if("load_use").alias("load_use"),
    )

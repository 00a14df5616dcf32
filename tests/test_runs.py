"""Traces, predictions and synthetic draws."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.draws import cumulative
from shelfmark.operators.ordered import position_block
from shelfmark.operators.predict import dominant_category, dominant_key, prediction_label
from shelfmark.operators.synth import (
    ARITH_WEIGHTS,
    CATEGORY_WEIGHTS,
    arithmetic_value,
    dependent_draw,
    memory_offset,
    pick_members,
    upper_value,
    weighted_category,
)
from shelfmark.operators.trace import adjacent_dependencies, or_na, run_kpis
from tests.conftest import tuples

pytestmark = pytest.mark.usefixtures("no_broadcast")

TRACE = "run int, type string, issued_cycle int, commit_cycle int, flushed boolean, mispredicted boolean"


def test_kpis(spark):
    rows = [
        (1, "add", 1, 4, False, False), (1, "branch", 2, 6, False, True), (1, "branch", 3, 7, False, False),
        (1, "branch", 3, 8, False, False), (1, "load", 4, None, True, False), (1, "load", 4, 9, True, False),
        (2, "add", 1, None, False, False),
    ]
    got = run_kpis(spark.createDataFrame(rows, TRACE), ["run"])
    assert tuples(got) == [
        (1, 6, 4, 9, 3, 1, 0.444, 2.25, 66.67, 33.33),
        (2, 1, 0, 1, 0, 0, 0.0, None, None, 0.0),
    ]
    shown = got.orderBy("run").select(or_na("branch_accuracy", 2), or_na("cpi", 3), or_na("ipc", 3))
    assert [tuple(r) for r in shown.collect()] == [("66.67", "2.250", "0.444"), ("N/A", "N/A", "0.000")]


def test_adjacent(spark):
    rows = [
        (1, 0, "load", 5, 0, 0), (1, 1, "add", 6, 5, 1), (1, 2, "add", 6, 5, 6), (1, 3, "add", 0, 6, None),
        (1, 4, "add", 1, 0, 6), (2, 0, "add", 5, 5, 5),
    ]
    df = spark.createDataFrame(rows, "run int, pos int, type string, rd int, rs1 int, rs2 int")
    for block in (1, 2, 100):
        got = adjacent_dependencies(df, ["run"], ["pos"], position_block("pos", block))
        assert tuples(got, "run", "pos", "raw_rs1", "raw_rs2", "waw", "load_use") == [
            (1, 0, 0, 0, False, False),
            (1, 1, 1, 0, False, True),
            (1, 2, 2, 1, True, False),
            (1, 3, 1, 0, False, False),
            (1, 4, 0, 2, False, False),
            (2, 0, 0, 0, False, False),
        ]


def test_predictions(spark):
    df = spark.sql("""SELECT map('Man', 40.0D, 'Woman', 60.0D) AS gender, 30.5D AS age, 'happy' AS mood, 'x' AS race
        UNION ALL SELECT map('b', 1.0D, 'a', 1.0D), 31.5D, 'sad', 'y' UNION ALL SELECT NULL, 1.0D, 'sad', 'y'""")
    got = df.select(dominant_key("gender"), prediction_label(dominant_key("gender"), "age", "mood", "race"))
    assert tuples(got) == [("Woman", "Woman, 30 yrs\nhappy, x"), ("a", "a, 32 yrs\nsad, y"), (None, "No prediction")]
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "d"), (2, "c")], "k int, c string")
    assert tuples(dominant_category(votes, ["k"], "c")) == [(1, "b", 2), (2, "c", 1)]


def test_draws_follow_the_weights_and_repeat(spark):
    n = 40_000
    ids = spark.range(n)
    drawn = ids.select("id", weighted_category("id", 3).alias("c"))
    counts = {r["c"]: r["count"] for r in drawn.groupBy("c").count().collect()}
    for key, weight in CATEGORY_WEIGHTS.items():
        share = weight / sum(CATEGORY_WEIGHTS.values())
        assert abs(counts[key] / n - share) < 4 * (share * (1 - share) / n) ** 0.5 + 1e-4
    assert tuples(drawn.repartition(7).where("id < 50")) == tuples(drawn.where("id < 50"))
    assert tuples(ids.select("id", weighted_category("id", 4)).where("id < 50")) != tuples(drawn.where("id < 50"))
    assert cumulative({"a": 1, "b": 3}) == [("a", 0.25), ("b", 1.0)]


def test_mixtures_stay_in_their_buckets(spark):
    row = spark.range(20_000).select(
        arithmetic_value("id", 1).alias("a"), memory_offset("id", 1).alias("m"), upper_value("id", 1).alias("u")
    ).agg(
        F.min("a"), F.max("a"), F.avg(F.col("a").between(-1, 1).cast("int")), F.min("m"), F.max("m"),
        F.max(F.col("m") % 4), F.avg((F.col("m") == 0).cast("int")), F.min("u"), F.max("u") < 2**20,
        F.avg(F.col("u").isin(1, 16, 256).cast("int")),
    ).first()
    assert (row[0], row[1]) == (-2048, 2048)
    assert abs(row[2] - (ARITH_WEIGHTS["small"] + 0.2 * 3 / 65)) < 0.02
    assert (row[3], row[5]) == (0, 0) and 256 <= row[4] < 1024
    assert abs(row[6] - 0.15) < 0.02
    assert row[7] >= 0 and row[8] and abs(row[9] - 0.6) < 0.02


def test_members_are_picked_evenly_with_a_default(spark):
    members = spark.createDataFrame([("a", m) for m in range(5)] + [("b", 9)], "c string, m int")
    asked = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "none").when(F.col("id") % 10 == 1, "b").otherwise("a").alias("c"))
    got = pick_members(asked, members, "c", "m", ["id"], 1, "ADDI", position_block("m", 2))
    counts = {(r["c"], r["m"]): r["count"] for r in got.groupBy("c", "m").count().collect()}
    assert counts[("none", "ADDI")] == 500 and counts[("b", "9")] == 500
    assert all(abs(counts[("a", str(m))] - 800) < 120 for m in range(5)) and sum(counts.values()) == 5000


def test_dependent_draw(spark):
    rows = [(1, p, "load" if p % 2 else "add", p % 32, 100, None if p % 3 else 200) for p in range(3000)]
    df = spark.createDataFrame(rows, "run int, pos int, type string, rd int, rs1 int, rs2 int")
    certain = dependent_draw(df, ["run"], ["pos"], position_block("pos", 64), "pos", 1, raw=1.0, waw=1.0, load_use=0.0)
    by_pos = {r["pos"]: r for r in certain.collect()}
    assert by_pos[0]["rs1"] == 100 and by_pos[5]["rs1"] == 4 and by_pos[5]["rd"] == 4
    assert by_pos[33]["rs1"] == 100 and by_pos[33]["rd"] == 0
    never = dependent_draw(df, ["run"], ["pos"], position_block("pos", 64), "pos", 1, raw=0, waw=0, load_use=0)
    assert tuples(never, *df.columns) == tuples(df)
    some = dependent_draw(df, ["run"], ["pos"], position_block("pos", 64), "pos", 1, raw=0.4, waw=0, load_use=0)
    share = some.where("rs1 <> 100").count() / 3000
    assert abs(share - 0.4 * 31 / 32) < 0.05

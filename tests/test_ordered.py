"""Block-wise operators against plain Python, also with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.ordered import carry_last, numbered, position_block, shifted
from shelfmark.operators.skew import mark_first, skew_join, with_group_value
from shelfmark.operators.topk import keep_first, sample_per_group, top_per_group

pytestmark = pytest.mark.usefixtures("no_broadcast")


def skewed_rows(n=600, seed=3):
    rng = random.Random(seed)
    keys = [None if rng.random() < 0.05 else ("hot" if rng.random() < 0.6 else rng.choice("abcdef"))
            for _ in range(n)]
    positions = rng.sample(range(n * 3), n)
    return [(k, p, rng.choice([None, None, rng.randint(0, 9)])) for k, p in zip(keys, positions)]


@pytest.fixture(scope="module")
def rows():
    return skewed_rows()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, pos int, v int").repartition(5)


def groups(rows):
    out = {}
    for row in sorted(rows, key=lambda r: r[1]):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("block", [1, 7, 50, 10_000])
def test_carry_last(df, rows, block):
    got = carry_last(df, ["k"], ["pos"], position_block("pos", block), {"last": F.col("v")})
    expected = set()
    for members in groups(rows).values():
        last = None
        for k, pos, v in members:
            last = v if v is not None else last
            expected.add((k, pos, v, last))
    assert set(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("block", [1, 7, 50, 10_000])
def test_shifted(df, rows, block):
    got = shifted(
        df, ["k"], ["pos"], position_block("pos", block),
        {"b1": (F.col("pos"), 1), "b2": (F.col("pos"), 2), "a1": (F.col("pos"), -1)},
    ).select("k", "pos", "b1", "b2", "a1")
    expected = []
    for members in groups(rows).values():
        p = [m[1] for m in members]
        for i, (k, pos, _) in enumerate(members):
            expected.append(
                (k, pos, p[i - 1] if i else None, p[i - 2] if i > 1 else None,
                 p[i + 1] if i + 1 < len(p) else None)
            )
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(expected) and set(got) == set(expected)


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_numbered(df, rows, block):
    got = numbered(df, ["k"], ["pos"], position_block("pos", block), "n")
    expected = {
        (k, pos, i) for members in groups(rows).values() for i, (k, pos, _) in enumerate(members, 1)
    }
    assert {(r["k"], r["pos"], r["n"]) for r in got.collect()} == expected


def test_skew_join_keeps_all_rows_and_matches_null_keys(spark, df, rows):
    right = spark.createDataFrame([("hot", 1), ("a", 2), (None, 3)], "k string, w int")
    got = skew_join(df, right, ["k"])
    weights = {"hot": 1, "a": 2, None: 3}
    assert {(r["k"], r["pos"], r["w"]) for r in got.collect()} == {
        (k, p, weights.get(k)) for k, p, _ in rows
    }
    inner = skew_join(df, right, ["k"], how="inner")
    assert inner.count() == sum(k in weights for k, _, _ in rows)


def test_rows_made_by_a_plan_are_not_broadcast(spark, df, tmp_path, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    request.addfinalizer(lambda: spark.conf.set(name, before))
    spark.conf.set(name, "10MB")
    from shelfmark.session import fits_broadcast

    spark.createDataFrame([("a", 1000), ("hot", 1000)], "k string, n int").write.parquet(f"{tmp_path}/listed")
    listed = spark.read.parquet(f"{tmp_path}/listed")
    assert fits_broadcast(listed.where("n > 1").select("k"))
    exploded = listed.select("k", F.explode(F.sequence(F.lit(1), "n")).alias("w"))
    assert not fits_broadcast(exploded)
    assert not fits_broadcast(listed.join(listed.withColumnRenamed("n", "m"), "k"))
    plan = skew_join(df, exploded.dropDuplicates(["k"]), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_group_values(df, rows):
    got = with_group_value(
        df, ["k"],
        {"lo": (F.min("pos"), "min"), "n": (F.count(F.lit(1)), "sum"), "hi": (F.max("v"), "max")},
        ["pos"],
    )
    by_key = groups(rows)
    for r in got.collect():
        members = by_key[r["k"]]
        filled = [m[2] for m in members if m[2] is not None]
        assert (r["lo"], r["n"], r["hi"]) == (
            members[0][1], len(members), max(filled) if filled else None
        )
    assert got.count() == len(rows)


def test_top_keep_first_and_sample(df, rows):
    by_key = groups(rows)
    top = top_per_group(df, ["k"], [F.desc("pos")], 3)
    assert {(r["k"], r["pos"]) for r in top.collect()} == {
        (k, m[1]) for k, members in by_key.items() for m in members[-3:]
    }
    first = keep_first(df, ["k"], ["pos"])
    assert {(r["k"], r["pos"]) for r in first.collect()} == {
        (k, members[0][1]) for k, members in by_key.items()
    }
    sample = sample_per_group(df, ["k"], ["pos"], 15, seed=1)
    counts = {r["k"]: r["count"] for r in sample.groupBy("k").count().collect()}
    assert counts == {k: min(15, len(m)) for k, m in by_key.items()}
    again = sample_per_group(df.repartition(2), ["k"], ["pos"], 15, seed=1)
    assert {r["pos"] for r in again.collect()} == {r["pos"] for r in sample.collect()}
    other = sample_per_group(df, ["k"], ["pos"], 15, seed=2)
    assert {r["pos"] for r in other.collect()} != {r["pos"] for r in sample.collect()}


def test_mark_first(df, rows):
    got = mark_first(df, ["k"], ["pos"], F.col("v") > 3, "first")
    expected = {}
    for k, members in groups(rows).items():
        fits = [m[1] for m in members if m[2] is not None and m[2] > 3]
        expected[k] = fits[0] if fits else None
    assert {(r["k"], r["pos"], r["first"]) for r in got.collect()} == {
        (k, p, p == expected[k]) for k, p, _ in rows
    }

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.match import first_band_match

pytestmark = pytest.mark.usefixtures("no_broadcast")

DIMS = {"x": 50, "y": 50, "w": 50, "h": 50}


def matches(spark, probes, stored, dims=DIMS, earlier=False, small=10_000):
    names = ", ".join(f"{d} double" for d in dims)
    p = spark.createDataFrame(probes, f"s string, id int, {names}")
    q = spark.createDataFrame(stored, f"s string, n int, {names}")
    got = first_band_match(
        p, q, ["s"], dims, ["n"], [], ["id"], earlier_than=["id"] if earlier else None,
        small_pair=small,
    )
    return {r["id"]: r["match"]["n"] if r["match"] else None for r in got.collect()}


def brute(probes, stored, dims=DIMS, earlier=False):
    out = {}
    for s, i, *box in probes:
        fits = [
            n for t, n, *other in stored
            if s == t and all(abs(a - b) < tol for a, b, tol in zip(box, other, dims.values()))
            and (not earlier or n < i)
        ]
        out[i] = min(fits) if fits else None
    return out


def test_difference_must_be_below_the_tolerance(spark):
    stored = [("a", 1, 100.0, 10.0, 30.0, 30.0), ("a", 2, 60.0, 10.0, 30.0, 30.0)]
    probes = [
        ("a", 1, 149.0, 10.0, 30.0, 30.0),
        ("a", 2, 150.0, 10.0, 30.0, 30.0),
        ("a", 3, 80.0, 10.0, 30.0, 30.0),
        ("a", 4, 51.0, 10.0, 30.0, 30.0),
        ("a", 5, 50.0, 10.0, 30.0, 30.0),
        ("b", 6, 100.0, 10.0, 30.0, 30.0),
    ]
    assert matches(spark, probes, stored) == {1: 1, 2: None, 3: 1, 4: 1, 5: 2, 6: None}


@pytest.mark.parametrize("small", [0, 40, 10_000])
def test_equals_brute_force_with_a_hot_key_and_copies(spark, small):
    rng = random.Random(11)

    def boxes(n):
        out = []
        for i in range(n):
            s = "hot" if rng.random() < 0.6 else rng.choice("abc")
            point = [float(rng.randint(-150, 150)) for _ in range(2)]
            if rng.random() < 0.3:
                point = [5.0, 5.0]
            out.append((s, i, *point))
        return out

    dims = {"x": 20, "y": 35}
    probes, stored = boxes(400), boxes(300)
    assert matches(spark, probes, stored, dims, small=small) == brute(probes, stored, dims)
    if small:
        assert matches(spark, probes, probes, dims, True, small) == brute(probes, probes, dims, True)


def test_order_rising_along_a_dimension(spark):
    rows = [("a", i, float(i), float(i * 7 % 13)) for i in range(200)]
    dims = {"x": 20, "y": 5}
    assert matches(spark, rows, rows, dims, True, 30) == brute(rows, rows, dims, True)


def test_full_cells_are_not_paired_point_by_point(spark):
    """Two neighbouring cells of 20,480 points each: 419 million pairs if listed."""
    n = 80 * 256
    x = F.col("id") / 256.0
    rows = spark.range(2 * n).select(
        F.lit("a").alias("s"), F.col("id").alias("n"), x.alias("x"), ((F.col("id") * 17) % 64).alias("y")
    )
    got = first_band_match(rows, rows, ["s"], {"x": 80, "y": 100}, ["n"], [], ["n"])
    first = F.greatest(F.lit(0), F.col("n") - n + 1)
    wrong = got.where(F.col("match.n") != first)
    assert got.count() == 2 * n and wrong.count() == 0


def test_no_pairs_within_a_cell(spark):
    rows = spark.range(2000).select(
        F.lit("a").alias("s"), F.col("id").alias("n"), (F.col("id") % 10).alias("x"),
        (F.col("id") % 7).alias("y"),
    )
    got = first_band_match(rows, rows, ["s"], {"x": 100, "y": 100}, ["n"], [], ["n"])
    assert got.where("match.n = 0").count() == 2000

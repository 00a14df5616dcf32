"""Whitening against numpy's own eigenvalues and a plain version."""

import math
import random

import numpy as np
import pytest

from shelfmark.llm import whitening as Z

VECTORS = "vec_id long, embedding array<float>, n string, component string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, "a", "b", 3) for k, v in rows], VECTORS).repartition(3)


def vectors(n, dims, seed, spread=1.0):
    r = np.random.default_rng(seed)
    scale = spread * np.exp(-np.arange(dims) / 3)
    return [(k, [float(np.float32(x)) for x in r.normal(0, 1, dims) * scale + 0.3]) for k in range(n)]


def plain(rows):
    """x of every usable row, and n, mean, eigenvalues and eigenvectors of the distinct ones."""
    usable = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(v) for _, v in usable)
    xs = [(k, tuple([math.floor(256 * c) for c in v] + [0] * (dims - len(v)))) for k, v in usable]
    distinct = np.array(sorted({x for _, x in xs}), dtype=np.float64)
    values, columns = np.linalg.eigh(np.atleast_2d(np.cov(distinct.T, bias=True)))
    return xs, len(distinct), distinct, values[::-1], columns[:, ::-1]


def check(spark, rows, components=4):
    df = frame(spark, rows)
    model = Z.fit(df, components)
    got = {}
    for r in Z.whiten(df, model).collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    xs, n, distinct, values, columns = plain(rows)
    sums = distinct.sum(axis=0)
    assert sum(map(len, got.values())) == len(xs) * len(model.values)
    assert np.allclose(model.values, values[: len(model.values)], rtol=1e-12)
    for k in range(len(model.values)):
        assert abs(abs(model.components[k] @ columns[:, k]) - 1) < 1e-9
        sign = np.sign(model.components[k] @ columns[:, k])
        for id, x in xs:
            projected = sign * (np.array(x) - distinct.mean(axis=0)) @ columns[:, k] / math.sqrt(values[k])
            deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
            assert any(
                abs(r["whitened"] - projected) < 1e-8 and r["deviation"] == deviation and r["n"] == n for r in got[id, k + 1]
            )
            for r in got[id, k + 1]:
                assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9
                assert r["identity_error"] < 1e-9


def test_whitening_equals_plain(spark):
    rows = vectors(300, 12, 1)
    check(spark, rows + [(1000 + k, v) for k, v in rows[:50]] + [rows[0]])  # copies count once


def test_strips_of_the_covariance(spark, monkeypatch):
    monkeypatch.setattr(Z, "STRIP", 5)
    check(spark, vectors(80, 23, 2))


def test_awkward_vectors(spark):
    rows = vectors(40, 5, 3)
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0]), (104, [0.25, -0.5]), (105, []), (None, rows[0][1]), (5, rows[7][1])]
    check(spark, rows)


def test_fewer_components_than_dimensions(spark):
    line = [(k, [k / 4, k / 2, 1.0]) for k in range(9)]
    model = Z.fit(frame(spark, line))
    assert len(model.values) == 1
    check(spark, vectors(30, 2, 4))
    same = frame(spark, [(k, [1.0, 2.0]) for k in range(5)])
    assert Z.whiten(same, Z.fit(same)).collect() == []
    empty = frame(spark, []).limit(0)
    assert Z.fit(empty) is None and Z.whiten(empty, None).collect() == []
    assert Z.whiten(frame(spark, [(1, [])]), Z.fit(frame(spark, [(1, [])]))).collect() == []


def test_large_deviations_are_exact_or_null():
    model = Z.Model(3, [4 * 10**9], np.ones(1), np.ones((1, 1)), 1.0)
    assert model.deviations(np.array([[1], [10**9]])) == [None, 10**18]  # (3 - 4e9)^2 is beyond a long
    assert model.deviations(np.array([[1_333_333_333]])) == [1]


def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q * np.array(values) @ q.T


@pytest.mark.parametrize("values", [[9, 5, 5, 5, 1, 0, 0], [3] * 6, [4, 4 - 1e-9, 2, 1e-12], [7.0], [2.0, 1.0], [1e8, 1e-8, 1e-8]])
def test_eigenvectors_of_clusters(values):
    for seed in range(5):
        a = symmetric(values, seed)
        diagonal, off, reflections = Z.tridiagonal(a)
        found = Z.leading_values(diagonal, off, min(4, len(values)))
        assert np.allclose(found, sorted(values, reverse=True)[:4], rtol=1e-12, atol=1e-14 * max(values))
        rows = Z.components_of(diagonal, off, found, reflections)
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-12)
        assert np.allclose(rows @ a, found[:, None] * rows, atol=1e-12 * max(values) * len(values))


def test_diagonal_matrix_and_sturm_counts():
    diagonal, off, reflections = Z.tridiagonal(np.diag([1.0, 4.0, 4.0, 2.0, 3.0]))
    assert Z.counts_above(diagonal, off, np.array([0.5, 1.5, 3.5, 4.5])).tolist() == [5, 4, 2, 0]
    found = Z.leading_values(diagonal, off, 4)
    assert np.allclose(found, [4, 4, 3, 2], atol=1e-12)
    rows = Z.components_of(diagonal, off, found, reflections)
    assert np.allclose(rows @ rows.T, np.eye(4), atol=1e-12)
    r = random.Random(1)
    t = [r.uniform(-1, 1) for _ in range(30)], [r.uniform(-1, 1) for _ in range(29)]
    full = np.diag(t[0]) + np.diag(t[1], 1) + np.diag(t[1], -1)
    assert np.allclose(Z.leading_values(np.array(t[0]), np.array(t[1]), 30), np.linalg.eigvalsh(full)[::-1], atol=1e-13)

"""Whitening against dense eigenvectors, and the bidiagonal solver against numpy's singular values."""

import math

import numpy as np
import pytest

from tollgate.llm.whitening import bidiagonal, right_vectors, squared_values, whiten

SCHEMA = "vec_id long, embedding array<float>, component int, n string, whitened int"


def solve(x, count=8):
    size = x.shape[1]
    r = np.zeros((size, size))
    part = np.linalg.qr(x, mode="r")
    r[: len(part)] = part
    diagonal, above, right = bidiagonal(r)
    values, vectors = right_vectors(diagonal, above, count)
    for k in range(len(right) - 1, -1, -1):
        tail = vectors[:, k + 1 :]
        tail -= np.outer(tail @ right[k], right[k])
    return r, values, vectors


def matrices():
    rng = np.random.default_rng(1)
    yield rng.normal(size=(500, 64))
    yield rng.normal(size=(100, 64)) * np.logspace(0, -9, 64)
    yield np.vstack([np.eye(20)] * 3)
    yield np.hstack([rng.normal(size=(90, 5))] * 3 + [np.zeros((90, 2))])
    yield rng.normal(size=(3, 12))
    yield rng.normal(size=(30, 1))
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    yield (turn * np.array([3] * 5 + [2] * 10 + [1] * 25)) @ turn.T
    yield (turn * (1 + 1e-13 * np.arange(40))) @ turn.T
    for seed in range(60):
        g = np.random.default_rng(seed)
        yield g.integers(-2, 3, size=(g.integers(2, 15), g.integers(1, 12))).astype(float)


def test_solver():
    for x in matrices():
        r, values, vectors = solve(x)
        want = np.linalg.svd(r)[1] ** 2
        if want[0] == 0:
            assert not len(values)
            continue
        assert len(values) == min(8, (want > 1e-20 * want[0]).sum())
        assert np.abs(values - want[: len(values)]).max() < 1e-12 * want[0]
        assert np.abs(r.T @ (r @ vectors.T) - vectors.T * values).max() < 1e-11 * want[0]
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-10


def test_small_values_are_relatively_right():
    """dqds finds the smallest values of a graded matrix as exactly as the largest."""
    diagonal, above = np.logspace(0, -30, 20), np.full(19, 0.5) * np.logspace(0, -30, 20)[:-1]
    found = squared_values(diagonal, above)
    # the product of all values is that of the squared diagonal, to every digit
    assert np.log(found).sum() == pytest.approx(2 * np.log(diagonal).sum(), abs=1e-10)


def brute(vectors):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    rows = ((n * x - sums) / n).astype(float)
    values, directions = np.linalg.eigh(rows.T @ rows / n)
    return n, deviation, rows, values[::-1], directions[:, ::-1]


def test_whiten(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(700, 12)) * np.linspace(2, 0.1, 12)).astype(np.float32)
    data = [(i if i % 5 else None, [float(c) for c in v], 1, "x", 2) for i, v in enumerate(vectors)]
    data.append(data[3])
    odd = [(1, None), (2, [1.0, None] * 6), (3, [float("nan")] * 12), (4, [float("inf")] * 12), (5, [1.0]), (6, [])]
    odd = [(*one, 1, "x", 2) for one in odd]
    found = whiten(spark.createDataFrame(data + odd, SCHEMA).repartition(20)).collect()
    n, deviation, rows, values, directions = brute([one[1] for one in data])
    assert len(found) == 701 * 8 and {r.n for r in found} == {701}
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviation)
    white = rows @ directions[:, :8] / np.sqrt(values[:8])
    for k in range(1, 9):
        mine = [r for r in found if r.component == k]
        assert {r.explained for r in mine} == {mine[0].explained}
        assert mine[0].explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-10)
        got = sorted((-1 if r.vec_id is None else r.vec_id, r.deviation, r.whitened) for r in mine)
        want = sorted((-1 if one[0] is None else one[0], d, w) for one, d, w in zip(data, deviation, white[:, k - 1], strict=True))
        got, want = np.array([g[2] for g in got]), np.array([w[2] for w in want])
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-9
    assert {r.identity_error < 1e-10 for r in found} == {True}


def test_large_components(spark):
    """Components far beyond a long, and deviations that pass one: null, not an error."""
    data = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0])]
    found = whiten(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    held = [[2**60, 0], [-(2**60), 1024], [5120, 2048]]  # such components are held at 2^60
    sums = [sum(x) for x in zip(*held, strict=True)]
    third = sum((3 * x - s) ** 2 for x, s in zip(held[2], sums, strict=True))
    assert {(r.vec_id, r.deviation) for r in found} == {(1, None), (2, None), (3, third)}


def test_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []
    line = whiten(spark.createDataFrame([(i, [float(i), 7.0]) for i in range(9)], schema)).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1.0)

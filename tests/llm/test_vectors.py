"""Searches over embeddings against brute force."""

import math

import numpy as np
import pytest

from tollgate.llm.nndescent import nearest
from tollgate.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score int, id string, node int"


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def rows(seed, count, dims=8):
    rng = np.random.default_rng(seed)
    vectors = [[float(np.float32(x)) for x in rng.normal(size=dims)] for _ in range(count)]
    for i in range(count // 3):  # a third of all rows are one vector
        vectors[3 * i] = vectors[0]
    vectors[7], vectors[11], vectors[13], vectors[17] = None, [1.0, None] * 4, [0.0] * dims, [float("nan")] * dims
    vectors[19], vectors[23] = [1.0, 2.0], []
    found = [(i, v, 1, "x", 2) for i, v in enumerate(vectors)]
    return [*found, (None, vectors[1], 1, "x", 2)]


def brute(data, score, every):
    found = {}
    for q, x, *_ in data:
        if q is not None and q % every == 0 and usable(x):
            pairs = [(score(x, y), c) for c, y, *_ in data if c is not None and c != q and usable(y) and len(x) == len(y)]
            pairs = [(s, c) for s, c in pairs if s is not None]
            found[q] = sorted(pairs, key=lambda p: (-p[0], p[1]))[:5]
    return found


def grouped(result):
    found = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    return found


def product(x, y):
    return sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y))


def cosine(x, y):
    size = math.sqrt(sum(a * a for a in x)) * math.sqrt(sum(b * b for b in y))
    return sum(a * b for a, b in zip(x, y)) / size if size else None


@pytest.mark.parametrize("block", [4, 4096])
def test_exact_top_k(spark, block):
    data = rows(1, 240)
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = {q: [p for p in pairs] for q, pairs in brute(data, product, 10).items()}
    found = grouped(exact_top_k(docs, query_every=10, query_block=block, bins=16))
    assert found == {q: pairs for q, pairs in want.items() if pairs}


def test_exact_top_k_counts_repeated_rows_and_large_numbers(spark):
    data = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1e9]), (3, [-1e9])]
    docs = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found = grouped(exact_top_k(docs))[0]
    assert found == [(256 * 256 * 10**9, 2), (2 * 65536, 1), (2 * 65536, 1), (-256 * 256 * 10**9, 3)]


def test_nearest(spark):
    data = rows(2, 240)
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = brute(data, cosine, 10)
    found = grouped(nearest(docs, query_every=10))
    hits = total = 0
    for q, pairs in want.items():
        got = dict((c, s) for s, c in found.get(q, []))
        total += len(pairs)
        hits += sum(c in got for _, c in pairs)
        assert all(got[c] == pytest.approx(s, abs=1e-12) for s, c in pairs if c in got)
    assert hits >= 0.95 * total
    # copies of the query's own vector: the smallest ids, in order
    assert [c for _, c in found[0]] == [3, 6, 9, 12, 15]


def test_nearest_by_the_graph_alone(spark):
    """Small start blocks, one table and a narrow beam: recall comes from rounds until convergence."""
    vectors = np.random.default_rng(4).normal(size=(3000, 8)).astype(np.float32)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    docs = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = grouped(nearest(docs, degree=10, reverse=10, beam=10, expanded=4, tables=1, block_rows=20))
    hits = 0
    for q in range(0, len(vectors), 50):
        sims = units @ units[q]
        sims[q] = -2
        hits += len(set(np.argsort(-sims)[:5].tolist()) & {c for _, c in found[q]})
    assert hits >= 0.95 * 5 * len(found) and len(found) == 60


@pytest.mark.parametrize("operator", [exact_top_k, nearest])
def test_empty(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(50, [1.0, 2.0], 1, "x", 1)], SCHEMA)
    assert operator(alone).collect() == []

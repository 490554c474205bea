"""Exact top-k and multi-index hashing against brute force, with null, tied and odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from careflow.llm import hash_search, topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def rows(n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(0, scale, dim)], 0, "x", 1) for i in range(n)]


def odd_rows(dim):
    nan, inf = float("nan"), float("inf")
    base = rows(60, dim, 5)
    tie = base[3][1]
    return base + [(60, None, 0, "x", 1), (61, [None] + tie[1:], 0, "x", 1), (62, [nan] + tie[1:], 0, "x", 1),
                   (63, [inf] + tie[1:], 0, "x", 1), (None, tie, 0, "x", 1), (64, tie, 0, "x", 1), (65, tie, 0, "x", 1),
                   (64, tie, 0, "x", 1), (66, [0.0] * dim, 0, "x", 1), (67, [], 0, "x", 1), (100, tie[:2], 0, "x", 1)]


def fine(data, zero_ok):
    out = {}
    for i, v, *_ in data:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero_ok or any(v):
            out[i] = v
    return out


def brute(vectors, k, step, make):
    dim = max(map(len, vectors.values()), default=0)
    ids = sorted(vectors)
    m = np.array([make(np.array(vectors[i] + [0.0] * (dim - len(vectors[i])))) for i in ids])
    out = {}
    for a, q in zip(ids, m):
        if a % step == 0:
            scored = sorted((-float(q @ x), b) for b, x in zip(ids, m) if b != a)
            out[a] = [(b, -s) for s, b in scored[:k]]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("data", [rows(400, 12, 1), odd_rows(8), rows(3, 4, 2), rows(200, 3, 7, 0.01)])
def test_threshold_algorithm_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = collected(topk.exact_top_k(df, F.col("id") % 10 == 0, 5))
    want = brute(fine(data, True), 5, 10, lambda v: np.floor(256 * v))
    assert got == {q: [(b, int(s)) for b, s in found] for q, found in want.items()}


def test_threshold_stops_early():
    rng = np.random.default_rng(3)
    values = np.floor(256 * rng.normal(0, 0.01, (5000, 4)))
    values[17] = 4000.0
    lists = np.argsort(values, axis=0).T
    lists.flags.writeable = False
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], slice):
                reads.append(key[1].stop)
            return super().__getitem__(key)

    best, score = topk.threshold_top(lists.view(Counted), values, np.arange(5000), np.array([1.0, 2, 3, 4]), -1, 1)
    assert best.tolist() == [17] and score[0] == 40000 and len(reads) == 2


def test_hash_search_recall_and_scores(spark):
    data = rows(1500, 32, 11)
    df = spark.createDataFrame(data, SCHEMA)
    got = collected(hash_search.nearest(df, F.col("id") % 20 == 0, 20))
    want = brute(fine(data, False), 20, 20, lambda v: v)
    hit = sum(len({b for b, _ in want[q]} & {b for b, _ in got[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    assert all(len(got[q]) == 20 for q in want)
    vectors = {i: np.array(v) for i, v, *_ in data}
    assert all(abs(s - vectors[q] @ vectors[b]) < 1e-9 for q in got for b, s in got[q])


def test_hash_search_odd_vectors(spark):
    df = spark.createDataFrame(odd_rows(8), SCHEMA)
    got = collected(hash_search.nearest(df, F.col("id") % 20 == 0, 200))
    usable = fine(odd_rows(8), False)
    assert set(got) == {i for i in usable if i % 20 == 0}
    assert all({b for b, _ in found} == set(usable) - {q} for q, found in got.items())


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (3000, 4), dtype=np.uint8)
    index = hash_search.BlockIndex(codes)
    for radius in (0, 3, 7, 12, 32):
        for code in codes[:20]:
            bits = np.unpackbits(codes ^ code, axis=1).sum(1)
            assert index.within(code, radius).tolist() == np.flatnonzero(bits <= radius).tolist()


@pytest.mark.parametrize("data", [[], [(0, [], 0, "x", 1)], [(0, None, 0, "x", 1)], [(0, [1.0], 0, "x", 1)]])
def test_searches_of_almost_nothing(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert topk.exact_top_k(df, F.col("id") % 10 == 0, 5).count() == 0
    assert hash_search.nearest(df, F.col("id") % 10 == 0, 5).count() == 0


@pytest.mark.parametrize("size", [3.0e5, 1.0e9])
def test_large_components_are_scored_exactly(spark, size):
    """Beyond what doubles sum exactly the scores are integers; no vector is left out."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, size if i % 3 else 1.0, 16)]) for i in range(200)]
    got = collected(topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                     F.col("id") % 10 == 0, 5))
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = {}
    for q in range(0, 200, 10):
        scores = [(-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q]
        want[q] = [(i, -s) for s, i in sorted(scores)[:5]]
    if size == 3.0e5:
        assert got == want
    else:  # sums beyond a long: the nearest long
        for q, found in want.items():
            assert [s for _, s in got[q]] == pytest.approx([min(s, 2**63 - 1) for _, s in found], rel=1e-12)


def test_equal_vectors_tie_by_id(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (40, 24))
    rows = [(i, [float(x) for x in base[i % 40]]) for i in range(1200)]
    got = collected(hash_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                        F.col("id") % 20 == 0, 20))
    for q, found in got.items():
        scores = {}
        for i, s in found:
            scores.setdefault(i % 40, set()).add(s)
        assert all(len(x) == 1 for x in scores.values())
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))

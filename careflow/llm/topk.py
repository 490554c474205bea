"""Exact top-k inner-product search by Fagin's threshold algorithm.

Every candidate block keeps one sorted list per dimension. A query reads its lists in rounds of
growing depth from their favourable end (the largest values for a positive query component, the
smallest for a negative one), scores each newly seen vector in full, and stops when the bound
of everything unseen, the sum of the components times the last values read, cannot reach the
kth best score; while the bound equals it, ties could still win by a smaller id, so reading
goes on.

Products are summed as doubles where a block's largest components prove that every sum stays within
2**53, else as 64-bit integers, so that scores and bounds are exact for any scores a long can hold.

Defined cases: see ``vectors``; zero components' lists are not read; a query with fewer than k
candidates gets them all; where a block's sums could leave a long, they are compared as doubles
and the score is the nearest long.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import stage
from careflow.llm.vectors import search, top, usable

FIRST_DEPTH = 32
EXACT, LONG = float(1 << 53), float(1 << 63)


def exact_pair(values: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type that holds all of their inner products exactly."""
    most = np.abs(values).max(initial=0.0) * np.abs(query).max(initial=0.0) * values.shape[-1]
    if EXACT <= most < LONG:
        return values.astype(np.int64), query.astype(np.int64)
    return values, query


def as_longs(score: np.ndarray) -> np.ndarray:
    """Scores as longs, those beyond a long as the nearest one."""
    if score.dtype == np.int64:
        return score
    out = np.clip(score, -LONG, np.nextafter(LONG, 0)).astype(np.int64)
    out[score >= LONG] = np.iinfo(np.int64).max
    return out


def threshold_top(lists: np.ndarray, values: np.ndarray, ids: np.ndarray, query: np.ndarray,
                  own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the k best rows of ``values``, without the id ``own``.
    ``lists[d]``: positions in increasing order of component d."""
    n = len(ids)
    dims = np.flatnonzero(query)
    seen = np.zeros(n, bool)
    best, score = np.zeros(0, np.int64), np.zeros(0, values.dtype)
    lo, depth = 0, FIRST_DEPTH
    up, down = dims[query[dims] > 0], dims[query[dims] < 0]
    while True:
        hi = min(n, depth) if len(dims) else n
        fresh = np.zeros(n, bool)
        if len(dims):
            fresh[lists[up, n - hi:n - lo]] = True
            fresh[lists[down, lo:hi]] = True
            fresh &= ~seen
        else:
            fresh[:] = True
        seen |= fresh
        at = np.flatnonzero(fresh)
        at = at[ids[at] != own]
        best, score = np.concatenate([best, at]), np.concatenate([score, values[at] @ query])
        keep = top(score, ids[best], k)
        best, score = best[keep], score[keep]
        if hi == n:
            return best, score
        last = np.empty(len(query), values.dtype)
        last[up] = values[lists[up, n - hi], up]
        last[down] = values[lists[down, hi - 1], down]
        if len(best) == k and last[dims] @ query[dims] < score[-1]:
            return best, score
        lo, depth = hi, 2 * depth


def exact_top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = 256,
                id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Each query's k best (query_id, rank, vec_id, score) by the integer inner product of
    floor(scale * x). ``is_query`` is a condition on column ``id``."""
    # From 2**53 on, a double is whole; beyond all doubles, the largest stands for the product.
    def whole(x: Column) -> Column:
        y = F.greatest(F.least(x * scale, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    rows = stage(usable(vectors, id_col, vec_col).withColumn("v", F.transform("v", whole)), "vectors")
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0

    def find(query_ids, queries, ids, data):
        query = np.frombuffer(queries, np.float64).reshape(len(query_ids), dim)
        values = np.frombuffer(data, np.float64).reshape(len(ids), dim)
        lists = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)
        values, query = exact_pair(values, query)
        out = [threshold_top(lists, values, ids, q, own, k) for q, own in zip(query, query_ids)]
        return (np.repeat(query_ids, [len(b) for b, _ in out]),
                ids[np.concatenate([b for b, _ in out]).astype(np.int64)],
                as_longs(np.concatenate([s for _, s in out])))

    def encode(m):
        return m.tobytes()

    return search(rows, is_query, k, dim, encode, encode, find, "long")

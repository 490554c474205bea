"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

The rotation is learned on a bounded sample (``Params.sample`` rows with the smallest id hash)
by iterative quantisation; every row is coded and indexed. Inner product becomes angle by one
added component that evens out the norms. A code is split into 8-bit substrings; each block
keeps, per substring, its rows sorted by that byte. Two codes within Hamming radius r differ by
at most r // m bits in one of the m substrings, so probing all bytes within that distance
retrieves every code within the radius; those are reranked by exact float products.

The radius is learned too: on the sample, the distance within which ``Params.target`` of the
true neighbours lie, carried over to the whole table by its k. Where fewer than k codes lie
within a query's radius in a block, the radius grows until k do or the block is exhausted.

Defined cases: see ``vectors``; zero and empty vectors take no part; fewer candidates than k
give fewer rows; ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import stage
from careflow.llm.vectors import matrix, search, top, usable


@dataclass(frozen=True)
class Params:
    sample: int = 4096
    tests: int = 200
    rounds: int = 40
    target: float = 0.985
    seed: int = 3


@dataclass(frozen=True)
class Codes:
    rotation: np.ndarray  # (dim + 1, bits)
    norm2: float          # largest squared norm
    radius: int

    def code(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Packed bits, one row of bytes per vector."""
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))
        return np.packbits(np.column_stack([x, rest]) @ self.rotation > 0, axis=1)


_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _BITS[codes ^ code].sum(axis=1, dtype=np.int64)


def learn(sample: np.ndarray, norm2: float, k: int, p: Params) -> Codes:
    """Iterative quantisation: alternate the bits and the rotation (orthogonal Procrustes)."""
    dim = sample.shape[1]
    bits = max(8, -(-dim // 8) * 8)
    x = np.column_stack([sample, np.sqrt(np.maximum(norm2 - (sample * sample).sum(1), 0))])
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :bits]
    rng = np.random.default_rng(p.seed)
    extra = bits - axes.shape[1]
    if extra > 0:  # fewer dimensions than bits: the rest are random directions
        axes = np.column_stack([axes, rng.normal(size=(dim + 1, extra))])
    flat = x @ axes
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(p.rounds):
        u, _, v = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
        turn = u @ v
    codes = Codes(axes @ turn, norm2, 0)
    ask = sample[:p.tests]
    scores = ask @ sample.T
    scores[np.arange(len(ask)), np.arange(len(ask))] = -np.inf
    take = min(k, len(sample) - 1)
    if take < 1:
        return Codes(codes.rotation, norm2, bits)
    near = np.argpartition(-scores, take - 1, axis=1)[:, :take]
    base, own = codes.code(sample, False), codes.code(ask, True)
    far = np.array([distances(base[n], c) for n, c in zip(near, own)])
    return Codes(codes.rotation, norm2, int(np.quantile(far, p.target)))


class BlockIndex:
    """Per substring the rows sorted by its byte."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.m = codes.shape[1]
        self.lists = np.argsort(codes, axis=0, kind="stable").T
        self.offsets = np.array([np.concatenate([[0], np.cumsum(np.bincount(codes[:, j], minlength=256))])
                                 for j in range(self.m)])
        self.near = [np.flatnonzero(_BITS == d) for d in range(9)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of every code within the radius."""
        mark = np.zeros(len(self.codes), bool)
        masks = np.concatenate(self.near[:min(8, radius // self.m) + 1])
        for j in range(self.m):
            probe = np.zeros(256, bool)
            probe[masks ^ code[j]] = True
            edge = np.flatnonzero(np.diff(np.concatenate([[0], probe.view(np.int8), [0]])))
            for a, b in zip(edge[::2], edge[1::2]):  # neighbouring bytes are one slice
                mark[self.lists[j, self.offsets[j, a]:self.offsets[j, b]]] = True
        at = np.flatnonzero(mark)
        return at[distances(self.codes[at], code) <= radius]


def nearest(vectors: DataFrame, is_query: Column, k: int, p: Params = Params(),
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Each query's k nearest found (query_id, rank, vec_id, score), by inner product."""
    rows = usable(vectors, id_col, vec_col).where(F.exists("v", lambda x: x != 0))
    rows = stage(rows, "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    dim, norm2 = rows.agg(F.max(F.size("v")), F.max(square)).first()
    dim, norm2 = dim or 0, norm2 or 0.0
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(p.sample).select("v").collect()
    codes = learn(matrix([r["v"] for r in picked], dim), norm2, k, p) if picked else None

    def find(query_ids, queries, ids, data):
        query = np.frombuffer(queries, np.float64).reshape(len(query_ids), dim)
        values = np.frombuffer(data, np.float64).reshape(len(ids), dim)
        index = BlockIndex(codes.code(values, False))
        bits = 8 * index.m
        found, scores = [], []
        for q, own, code in zip(query, query_ids, codes.code(query, True)):
            radius = codes.radius
            while True:
                at = index.within(code, radius)
                at = at[ids[at] != own]
                if len(at) >= k or radius >= bits:
                    break
                radius = min(bits, radius + index.m)
            s = (values[at] * q).sum(axis=1)  # every row in one order, so equal rows score alike
            keep = top(s, ids[at], k)
            found.append(at[keep])
            scores.append(s[keep])
        return (np.repeat(query_ids, [len(x) for x in found]), ids[np.concatenate(found)],
                np.concatenate(scores))

    def encode(m):
        return m.tobytes()

    return search(rows, is_query, k, dim, encode, encode, find, "double")

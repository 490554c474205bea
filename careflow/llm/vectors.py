"""Vector blocks shared by the searches: rows become one binary row per block, and every query
block meets every candidate block once, in a task of its own.

A usable vector is non-NULL, without NULL or non-finite components. Rows of one id are one
vector (the smallest in array order); a NULL id takes no part. Vectors of different lengths are
padded with zeros to the longest.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.common import by_key, stage

BLOCK = 8192
QUERY_BLOCK = 4096
_BLOB = "c int, q int, query boolean, ids binary, data binary"


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): distinct ids with vectors of doubles."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
            .groupBy("id").agg(F.min("v").alias("v")))


def matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _blobs(rows: DataFrame, blocks: int, query: bool, dim: int,
           encode: Callable[[np.ndarray], bytes]) -> DataFrame:
    side = "q" if query else "c"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        at = int(group["b"].iloc[0])
        return pd.DataFrame({"c": [-1 if query else at], "q": [at if query else -1], "query": [query],
                             "ids": [group["id"].to_numpy(np.int64).tobytes()],
                             "data": [encode(matrix(group["v"].tolist(), dim))]})

    dealt = rows.withColumn("b", F.pmod(F.xxhash64("id", F.lit(side)), F.lit(blocks)).cast("int"))
    return by_key(dealt, ["b"], run, _BLOB)


def search(vectors: DataFrame, is_query: Column, k: int, dim: int,
           encode_block: Callable[[np.ndarray], bytes], encode_query: Callable[[np.ndarray], bytes],
           find: Callable[[np.ndarray, bytes, np.ndarray, bytes], tuple[np.ndarray, np.ndarray, np.ndarray]],
           score_type: str) -> DataFrame:
    """Each query's k best (query_id, rank, vec_id, score) over all rows but its own.
    ``vectors`` is (id, v), staged; ``find`` gives a block pair's partial results."""
    total, asked = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, asks = max(1, math.ceil(total / BLOCK)), max(1, math.ceil(asked / QUERY_BLOCK))
    index = stage(_blobs(vectors, blocks, False, dim, encode_block)
                  .unionByName(_blobs(vectors.where(is_query), asks, True, dim, encode_query)), "blocks")
    pairs = index.withColumn("c", F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.lit(blocks - 1)))
                                            .otherwise(F.array("c"))))
    pairs = pairs.withColumn("q", F.explode(F.when(F.col("query"), F.array("q"))
                                            .otherwise(F.sequence(F.lit(0), F.lit(asks - 1)))))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sides = {bool(r.query): r for r in group.itertuples()}
        if len(sides) < 2:
            found = (np.zeros(0, np.int64),) * 3
        else:
            a, b = sides[True], sides[False]
            found = find(np.frombuffer(a.ids, np.int64), a.data, np.frombuffer(b.ids, np.int64), b.data)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    found = by_key(pairs, ["c", "q"], run, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], ~scores[at] if scores.dtype == np.int64 else -scores[at]))[:k]]

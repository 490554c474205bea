"""Shared helpers: staged tables in the shared folder, bounded slices, sorted-group streams.

Staged tables are Parquet folders below ``spark.checkpoint.dir`` (read from the session), so a
lost executor costs a retried task, never a lost intermediate. They are removed when the
driver process ends, or earlier by the operator that no longer needs them.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.session import checkpoint_dir

# Bounds the rows and bytes that one Arrow batch holds, whatever the texts' lengths.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

_STAGED: list[tuple[SparkSession, str]] = []


def bounded_batches(spark: SparkSession) -> SparkSession:
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; only Spark's reader opens it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage durably)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/careflow-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._careflow_stage = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    path = getattr(df, "_careflow_stage", None)
    if path is not None:
        _delete(df.sparkSession, path)
        _STAGED[:] = [x for x in _STAGED if x[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _STAGED:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session has ended: the shared folder's owner clears it
            return


_BITS = 1 << 26  # 8 MB, whatever the number of ids
_PART = 1 << 17


def maybe_in(ids: DataFrame) -> Callable[[Column], Column]:
    """A filter of fixed size for a column of ids: the returned condition is false only for ids
    (and NULL) that are not among ``ids``. It spares rows a shuffle before an exact join; the
    more ids there are, the fewer rows it spares."""
    spark = ids.sparkSession

    def spot(col: Column) -> Column:
        return F.pmod(F.xxhash64(col, F.lit(77)), F.lit(_BITS)).cast("int")

    def part(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(_PART, bool)
        bits[group["at"].to_numpy() % _PART] = True
        return pd.DataFrame({"part": group["part"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    at = ids.select(spot(F.col(ids.columns[0])).alias("at")).distinct()
    rows = by_key(at.withColumn("part", (F.col("at") / _PART).cast("int")), ["part"], part,
                  "part int, bits binary").collect()
    packed = np.zeros(_BITS // 8, np.uint8)
    for r in rows:
        packed[r["part"] * _PART // 8:(r["part"] + 1) * _PART // 8] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(packed)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = batch.to_numpy()
            yield pd.Series(shared.value[x >> 3] >> (7 - (x & 7)).astype(np.uint8) & 1 == 1)

    test = F.pandas_udf(run, "boolean")
    return lambda col: col.isNotNull() & test(spot(col))


def fold(key: Column | str, mod: int) -> Column:
    """crc32 of a key's decimal text, modulo ``mod``; a NULL key counts as empty text."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % mod


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive [start, end) row ranges of at most ``limit`` in total size; a row larger
    than the limit forms its own range."""
    start = total = n = 0
    for size in sizes:
        if n > start and total + size > limit:
            yield start, n
            start, total = n, 0
        total += size
        n += 1
    if n > start:
        yield start, n


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Flat positions of the ranges [start, start + len)."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.repeat(np.asarray(starts, np.int64) - (np.cumsum(lens) - lens), lens)
    out += np.arange(total, dtype=np.int64)
    return out


def sorted_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of consecutive equal keys from a partition sorted by ``keys``; a group may span
    several batches. The caller bounds the group's size."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        for key in keys:
            v = batch[key].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.iloc[a:b]
            key = tuple(part[k].iloc[0] for k in keys)
            if last is not None and key != last:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
            last = key
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def by_key(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
           schema: str) -> DataFrame:
    """``fn`` over every group of ``keys``: one shuffle, sorted partitions, groups streamed."""

    def run(batches):
        for group in sorted_groups(batches, keys):
            yield fn(group)

    return (df.repartition(*[F.col(k) for k in keys])
            .sortWithinPartitions(*keys)
            .mapInPandas(run, schema))


# 64-bit polynomial fingerprints of ranges of a flat array, by prefix sums modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_KEPT_POWERS = 1 << 19  # a worker keeps two tables of 4 MB; longer ones go with the texts they were for


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = list(_POWERS)
    for k, base in enumerate((_BASE, _INVERSE)):
        if len(out[k]) < n:
            p = np.full(1 << (n - 1).bit_length() if n <= _KEPT_POWERS else n, base, np.uint64)
            p[0] = 1
            out[k] = np.multiply.accumulate(p)
            if n <= _KEPT_POWERS:
                _POWERS[k] = out[k]
    return out[0], out[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class RangeHash:
    """Fingerprints of ranges of ``codes`` (small non-negative integers)."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        up, self._down = _powers(n + 1)
        x = codes.astype(np.uint64)
        x += np.uint64(1)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= up[:n]
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(x, out=self._sum[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self._sum[ends] - self._sum[starts]) * self._down[starts])

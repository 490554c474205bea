"""Best-fit packing by a grouping genetic algorithm on distributed islands.

Texts become token ids plus an end id; a document longer than a sequence is cut into full
pieces behind a shorter first one. Full pieces are sequences of their own. The rest is dealt by
hash into shards of about ``shard_items`` pieces. Several islands evolve each shard's packing:
crossover injects whole well-filled bins of one parent into the other, removes the bins that
hold duplicates, and best-fits the displaced pieces in decreasing order; mutation dissolves the
emptiest bins. After each epoch an island's elites also go to its neighbour, by a shuffle. A
shard stops early at its lower bound. The emptiest bins of a shard, about half of its items at
most, go on to a next level with half as many shards at most, until one shard is left, so that
shard borders do not cost sequences.

Defined cases: NULL and empty text is the end id alone; repeated rows are packed once each; a
NULL id is an id like any other; an empty table packs to no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.bpe import encoder
from careflow.llm.common import by_key, slices, stage

ENCODE_CHARS = 1 << 21


@dataclass(frozen=True)
class Params:
    capacity: int = 2048
    end_id: int = 0
    shard_items: int = 3000
    islands: int = 2
    epochs: int = 2
    population: int = 8
    generations: int = 20
    elites: int = 2
    good: float = 0.97
    seed: int = 9


def pieces(docs: DataFrame, path: str, p: Params, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    ident = docs.schema[id_col].dataType.simpleString()
    out_type = f"i {ident}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        end = np.array([p.end_id], np.uint32).tobytes()
        for batch in batches:
            texts = batch["t"].to_pylist()
            rows: list[int] = []
            out: list[tuple[int, int, int, int]] = []
            for lo, hi in slices((len(t or "") for t in texts), ENCODE_CHARS):
                counts, ids = bpe.encode_flat(texts[lo:hi])
                raw = memoryview(ids.astype("<u4").tobytes())
                at = 0
                for k, n in enumerate(counts.tolist(), lo):
                    total = n + 1
                    first = total % p.capacity or p.capacity
                    begin = 0
                    for j in range(-(-total // p.capacity)):
                        stop = first if j == 0 else begin + p.capacity
                        crc = zlib.crc32(raw[4 * (at + begin):4 * (at + min(stop, n))])
                        if stop == total:
                            crc = zlib.crc32(end, crc)
                        rows.append(k)
                        out.append((j, begin, stop - begin, crc))
                        begin = stop
                    at += n
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["i"].take(pa.array(rows, pa.int64())), *map(pa.array, cols, kinds)],
                names=["i", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(run, out_type).withColumnRenamed("i", id_col))


def best_fit(order: np.ndarray, sizes: list[int], bins: np.ndarray, rooms: list[tuple[int, int]],
             next_bin: int, capacity: int) -> int:
    """Put the items of ``order`` into the bin with the least sufficient room, else a new one.
    ``rooms`` is sorted by (room, bin) and updated; returns the next unused bin number."""
    for k in order.tolist():
        need = sizes[k]
        at = bisect_left(rooms, (need, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b = capacity, next_bin
            next_bin += 1
        bins[k] = b
        if room > need:
            insort(rooms, (room - need, b))
    return next_bin


class Island:
    """Evolves packings (arrays item -> bin) of items given in decreasing size."""

    def __init__(self, sizes: np.ndarray, p: Params, seed: int):
        self.sizes, self.list, self.p = sizes, sizes.tolist(), p
        self.rng = np.random.default_rng(seed)
        self.bound = -(-int(sizes.sum()) // p.capacity)

    def fresh(self, noise: float) -> np.ndarray:
        order = np.argsort(-self.sizes * (1 + noise * self.rng.random(len(self.sizes))), kind="stable")
        bins = np.empty(len(self.sizes), np.int64)
        best_fit(order, self.list, bins, [], 0, self.p.capacity)
        return bins

    def value(self, bins: np.ndarray) -> tuple[int, float]:
        """Fewer bins first, then fuller ones: the mean of squared fills."""
        fill = self.fills(bins)
        fill = fill[fill > 0]
        return -len(fill), float(((fill / self.p.capacity) ** 2).mean())

    def fills(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, self.sizes).astype(np.int64)

    def _refit(self, bins: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """Best-fit the loose items (mask) into the rooms that the others leave."""
        fixed = np.where(loose, -1, bins)
        _, fixed[~loose] = np.unique(fixed[~loose], return_inverse=True)
        count = int(fixed.max(initial=-1)) + 1
        room = self.p.capacity - np.bincount(fixed[~loose], self.sizes[~loose], minlength=count).astype(np.int64)
        rooms = sorted((r, b) for b, r in enumerate(room.tolist()) if r > 0)
        best_fit(np.flatnonzero(loose), self.list, fixed, rooms, count, self.p.capacity)
        return fixed

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        fill = self.fills(b)
        full = np.flatnonzero(fill >= np.quantile(fill[fill > 0], 0.5))
        inject = self.rng.random(len(fill)) < 0.3
        inject &= np.isin(np.arange(len(fill)), full)
        moved = inject[b]
        hit = np.zeros(int(a.max()) + 1, bool)
        hit[a[moved]] = True
        child = np.where(moved, b + int(a.max()) + 1, a)
        return self._refit(child, hit[a] & ~moved)

    def mutate(self, a: np.ndarray) -> np.ndarray:
        fill = self.fills(a)
        some = np.flatnonzero(fill)
        worst = some[np.argsort(fill[some])[:max(2, len(some) // 50)]]
        extra = self.rng.choice(some, min(len(some), 1 + len(some) // 50), replace=False)
        loose = np.isin(a, np.concatenate([worst, extra]))
        return self._refit(a, loose)

    def evolve(self, pool: list[np.ndarray]) -> list[np.ndarray]:
        p = self.p
        pool = pool or [self.fresh(0.0)]
        scored = sorted(((self.value(x), k, x) for k, x in enumerate(pool)), key=lambda s: (s[0], -s[1]), reverse=True)
        if -scored[0][0][0] > self.bound:
            while len(pool) < p.population:
                pool.append(self.fresh(0.3 * len(pool) / p.population))
            for _ in range(p.generations):
                values = [self.value(x) for x in pool]
                rank = sorted(range(len(pool)), key=lambda k: values[k], reverse=True)
                if -values[rank[0]][0] <= self.bound:
                    break
                pool = [pool[k] for k in rank[:p.population]]
                pairs = self.rng.integers(0, len(pool), (p.population // 2, 2))
                pool += [self.cross(pool[i], pool[j]) if i != j else self.mutate(pool[i]) for i, j in pairs]
                pool.append(self.mutate(pool[0]))
            scored = sorted(((self.value(x), k, x) for k, x in enumerate(pool)), key=lambda s: (s[0], -s[1]), reverse=True)
        return [x for _, _, x in scored[:p.elites]]


_ORDER = ["length", "i", "piece", "start", "ids_crc32"]


def _sorted_items(group: pd.DataFrame) -> pd.DataFrame:
    """Decreasing length; equal rows are interchangeable."""
    return group.sort_values(_ORDER, ascending=[False, True, True, True, True], kind="stable",
                             na_position="last")


def _pack_level(items: DataFrame, shards: int, level: int, p: Params) -> DataFrame:
    """Items (i, piece, start, length, ids_crc32) plus shard, bin, offset, and whether the bin is open:
    the emptiest bins that hold about half of the shard's items, as far as they are below ``good``."""
    kind = items.schema["i"].dataType.simpleString()
    items = items.withColumn("shard", F.pmod(F.xxhash64("i", "piece", "ids_crc32", F.lit(level)), F.lit(shards)).cast("int"))
    state = "shard int, island int, sizes binary, pool array<binary>"

    def begin(group: pd.DataFrame) -> pd.DataFrame:
        sizes = np.sort(group["length"].to_numpy())[::-1].astype(np.int32).tobytes()
        return pd.DataFrame({"shard": group["shard"].iloc[0], "island": range(p.islands),
                             "sizes": [sizes] * p.islands, "pool": [[]] * p.islands})

    def epoch(group: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(group["shard"].iloc[0]), int(group["island"].iloc[0])
        sizes = np.frombuffer(group["sizes"].iloc[0], np.int32).astype(np.int64)
        blobs = sorted({bytes(x) for pool in group["pool"] for x in pool})
        seed = hash((p.seed, level, shard, island, len(blobs))) % 2**32
        best = Island(sizes, p, seed).evolve([np.frombuffer(x, np.int32).astype(np.int64) for x in blobs])
        pool = [x.astype(np.int32).tobytes() for x in best]
        there = (island + 1) % p.islands
        homes = [island] if there == island else [island, there]
        return pd.DataFrame({"shard": shard, "island": homes, "sizes": [group["sizes"].iloc[0]] * len(homes),
                             "pool": [pool] * len(homes)})

    islands = by_key(items.select("shard", "length"), ["shard"], begin, state)
    for _ in range(p.epochs):
        islands = by_key(islands, ["shard", "island"], epoch, state)

    def settle(group: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        group = _sorted_items(group)
        sizes = group["length"].to_numpy()
        island = Island(sizes, p, 0)
        blobs = sorted({bytes(x) for pool in ends["pool"] for x in pool})
        bins = max((np.frombuffer(x, np.int32).astype(np.int64) for x in blobs), key=island.value)
        order = np.argsort(bins, kind="stable")
        at = np.cumsum(sizes[order]) - sizes[order]
        heads = np.searchsorted(bins[order], bins[order])
        offset = np.empty(len(bins), np.int64)
        offset[order] = at - at[heads]
        fills = island.fills(bins)
        members = np.bincount(bins, minlength=len(fills))
        emptiest = np.argsort(fills, kind="stable")
        before = np.cumsum(members[emptiest]) - members[emptiest]
        open_ = np.zeros(len(fills), bool)
        open_[emptiest] = (2 * before < len(bins)) & (fills[emptiest] < p.good * p.capacity)
        return group.assign(bin=bins, offset=offset, open=open_[bins])

    out = "i string, piece int, start long, length long, ids_crc32 long, shard int, bin long, offset long, open boolean"
    # ids cross pandas as text: a long beside a NULL would become a double there
    packed = (items.withColumn("i", F.col("i").cast("string")).groupBy("shard")
              .cogroup(stage(islands, "islands").groupBy("shard")).applyInPandas(settle, out))
    return packed.withColumn("i", F.col("i").cast(kind))


def pack(docs: DataFrame, path: str, p: Params = Params(), id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = stage(pieces(docs, path, p, id_col, text_col), "pieces").withColumnRenamed(id_col, "i")
    cols = ["i", "piece", "start", "length", "ids_crc32"]
    full = cut.where(F.col("length") >= p.capacity).select(
        *cols, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, items, level = full, cut.where(F.col("length") < p.capacity).select(*cols), 1
    count = items.count()
    shards = -(-count // p.shard_items)
    while count:
        packed = stage(_pack_level(items, shards, level, p), "packed")
        final = F.lit(True) if shards == 1 else ~F.col("open")
        number = F.lit(level << 58) + F.col("shard").cast("long") * (1 << 20) + F.col("bin")
        done = done.unionByName(packed.where(final).select(*cols, number.alias("sequence_id"), "offset"))
        items = packed.where(~final).select(*cols)
        count = items.count()
        # Every level has half as many shards at most, and the last one shard.
        shards, level = min(-(-count // p.shard_items), shards // 2), level + 1
    return done.withColumnRenamed("i", id_col)

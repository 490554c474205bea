"""MinHash near-duplicates by an LSH forest: sorted signature orders and their neighbours.

Every tree of the forest is one order of the distinct shingle sets: by their signature, the minima
of independent hash functions one after the other, a byte each. Neighbours in that order whose
longest common prefix reaches the depth are candidates, and candidates of all trees join into
regions (connected components, in Spark). The number of trees follows from the depth and the
wanted similarity so that a pair at the threshold is missed with probability below ``miss``.

The depth adapts to the region. All start at ``depth``; a region of more than ``dense`` sets
descends by a third of its depth at a time, with the more trees that the greater depth takes, until
it is small or ``deeper`` minima are used, while the others stay as they are. Orders are kept
from one depth to the next as long as their signatures reach it; only sets of dense regions get
further trees or longer signatures.

Within a region every link is decided on the full sets, by postings inside a task; only one row
per set leaves the task, never its pairs. A region too large for one task is dealt in blocks,
and block pairs are compared in tasks of their own. Equal sets are one node from the start, so
copies cost one row each.

Defined cases: NULL or empty text has an empty set, links with nothing and is kept; a NULL id is
its own component (component_id NULL) and kept; repeated rows of one id are one node and give
one output row each; texts are used whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import RangeHash, by_key, maybe_in, mix64, ragged, slices, stage, unstage

# Texts at a time. The fingerprints' tables and sums take some 60 bytes a byte, which a worker keeps
# for the stages after this one; with the blanks between texts they stay within 2**19 entries.
SLICE_BYTES = (1 << 19) - (1 << 12)
BLOCK_SETS = 1000
MINIMA = 16  # hash functions of a tree; a signature holds the first 8 or all of them
BLOCK_SHINGLES = 1_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Params:
    """Link when 100 * intersection >= ``percent`` * union of ``words``-word shingle sets."""

    words: int = 5
    percent: int = 80
    depth: int = 6
    deeper: int = MINIMA
    dense: int = 4000
    miss: float = 1e-6
    seed: int = 20

    def trees(self, depth: int) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** depth))

    def below(self, depth: int) -> int:
        """The depth a dense region descends to."""
        return min(depth + max(depth // 3, 1), self.deeper)


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingles of each text, flat and sorted per text, and their numbers."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    word = RangeHash(data)(starts, ends)
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(size + 1)]))
    n_words = np.diff(first)
    width = np.minimum(n_words, words)
    n = np.where(n_words > 0, n_words - width + 1, 0)
    at = ragged(first[:-1], n)
    width = np.repeat(width, n)
    total = np.full(len(at), 0x2545F4914F6CDD1D, np.uint64) * width.astype(np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    for k in range(words):
        total *= odd
        use = width > k
        total[use] += word[at[use] + k]
    total = mix64(total)
    offs = np.concatenate([[0], np.cumsum(n)])
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        if b - a > 1:
            total[a:b].sort()
    keep = np.ones(len(total), bool)
    keep[1:] = total[1:] != total[:-1]
    keep[offs[:-1][n > 0]] = True
    owner = np.repeat(np.arange(len(texts)), n)
    return total[keep], np.bincount(owner[keep], minlength=len(texts))


def signatures(sets: np.ndarray, n: np.ndarray, first: int, last: int, longs: int, seed: int) -> np.ndarray:
    """(non-empty set, tree, long): the signatures in the trees ``first`` to ``last``, a byte of
    each of the first ``8 * longs`` minima, the first minimum in the highest byte."""
    out = np.zeros((len(n), last - first, longs), np.uint64)
    draws = [np.random.default_rng([seed, t]).integers(0, 2**32, (3, MINIMA), dtype=np.uint32) | np.uint32(1)
             for t in range(first, last)]
    x = (sets >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(n)
    for lo, hi in slices(n.tolist(), 1 << 16):
        part = x[ends[lo] - n[lo]:ends[hi - 1]]
        offs = (ends - n)[lo:hi] - (ends[lo] - n[lo])
        for t, (a, b, c) in enumerate(draws):
            for k in range(8 * longs):
                low = np.minimum.reduceat(part * a[k] + b[k], offs)
                byte = (low * c[k] >> np.uint32(24)).astype(np.uint64)
                out[lo:hi, t, k // 8] |= byte << np.uint64(56 - 8 * (k % 8))
    return out


def common_prefix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading minima that signatures (row, long) have in common."""
    differ = (x ^ y).view(np.uint64)
    out = np.zeros(len(differ), np.int64)
    for part in range(differ.shape[1]):
        so_far = out == 8 * part
        for k in range(1, 9):
            out += so_far & (differ[:, part] >> np.uint64(64 - 8 * k) == 0)
    return out


def _signed(df: DataFrame, p: Params, first: int, last: int, longs: int) -> DataFrame:
    """(id, n, h1, h2, keys): set size, 128-bit digest of the set, signatures in the trees
    ``first`` to ``last`` (none for an empty set) of the rows (id, t)."""
    width = (last - first) * longs
    ident = pa.int64()
    schema = pa.schema([("id", ident), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch["t"].to_pylist()]
            for lo, hi in slices(map(len, texts), SLICE_BYTES):
                sets, n = shingles(texts[lo:hi], p.words)
                some = n > 0
                offs = (np.cumsum(n) - n)[some]
                h = np.zeros((2, hi - lo), np.uint64)
                keys = np.zeros(0, np.uint64)
                if len(offs):
                    h[0, some] = np.add.reduceat(mix64(sets ^ np.uint64(0x51)), offs)
                    h[1, some] = np.add.reduceat(mix64(sets ^ np.uint64(0xA7)), offs)
                    keys = signatures(sets, n[some], first, last, longs, p.seed)
                ends = np.concatenate([[0], np.cumsum(some * width)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"][lo:hi], pa.array(n), pa.array(h[0].view(np.int64)),
                     pa.array(h[1].view(np.int64)), lists], schema=schema)

    return df.select("id", "t").mapInArrow(run, "id long, n long, h1 long, h2 long, keys array<long>")


def _runs(tree: np.ndarray, sig: np.ndarray, ident: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in the order of their tree and signature: where a run of neighbours with a common
    prefix of ``depth`` minima starts, and each row's run start."""
    new = np.ones(len(tree), bool)
    new[1:] = (tree[1:] != tree[:-1]) | (common_prefix(sig[1:], sig[:-1]) < depth)
    return new, ident[np.maximum.accumulate(np.where(new, np.arange(len(tree)), 0))]


def _neighbours(sets: DataFrame, depth: int, first: int, longs: int) -> DataFrame:
    """Star edges (u, v) between sets (id, keys) that are neighbours in the order of a tree, the
    first of which is tree ``first``. Neighbours within one batch are joined before the shuffle,
    so a crowded region sends a row per batch and tree."""
    parts = [f"s{k}" for k in range(longs)]
    node = ", ".join(["kind int", "tree int", *(f"{x} long" for x in parts), "u long", "v long"])
    schema = pa.schema([("kind", pa.int32()), ("tree", pa.int32()), *((x, pa.int64()) for x in parts),
                        ("u", pa.int64()), ("v", pa.int64())])

    def rows(kind: int, tree: np.ndarray, sig: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(u), kind, np.int32)), pa.array(tree.astype(np.int32)),
             *(pa.array(np.ascontiguousarray(sig[:, k])) for k in range(longs)), pa.array(u), pa.array(v)], schema=schema)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = batch["keys"].flatten().to_numpy(zero_copy_only=False).reshape(-1, longs)
            trees = len(sig) // max(batch.num_rows, 1)
            ident = np.repeat(batch["id"].to_numpy(zero_copy_only=False), trees)
            tree = np.tile(np.arange(first, first + trees), batch.num_rows)
            order = np.lexsort((ident, *sig.T[::-1], tree))
            tree, sig, ident = tree[order], sig[order], ident[order]
            new, head = _runs(tree, sig, ident, depth)
            yield rows(0, tree[new], sig[new], ident[new], ident[new])
            yield rows(1, tree[~new], sig[~new], ident[~new], head[~new])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, ident = (batch[x].to_numpy(zero_copy_only=False) for x in ("tree", "u"))
            sig = np.stack([batch[x].to_numpy(zero_copy_only=False) for x in parts], axis=1)
            new, head = _runs(tree, sig, ident, depth)
            if last is not None and tree[0] == last[0] and common_prefix(sig[:1], last[1])[0] >= depth:
                head[:np.append(np.flatnonzero(new), len(new))[1]] = last[2]
                new[0] = False
            last = int(tree[-1]), sig[-1:].copy(), int(head[-1])
            yield rows(1, tree[~new], sig[~new], ident[~new], head[~new])

    found = sets.select("id", "keys").mapInArrow(local, node)
    inside = found.where("kind = 1").select("u", "v")
    # rows with a common prefix of the depth meet in one partition, in the order of their tree
    whole = depth // 8
    prefix = [F.col(x) for x in parts[:whole]]
    if depth % 8:
        prefix.append(F.shiftrightunsigned(parts[whole], 64 - 8 * (depth % 8)))
    between = (found.where("kind = 0").repartition("tree", *prefix)
               .sortWithinPartitions("tree", *parts, "u").mapInArrow(across, node).select("u", "v"))
    return inside.unionByName(between).where("u <> v").distinct()


def _forest(rows: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """(u, root): the regions of the sets (id, keys), whose keys are signatures of one long in the
    trees of the least depth; ``rows`` (id, t) give the sets of dense regions further ones."""
    depth, longs, grown = p.depth, 1, p.trees(p.depth)
    orders = [(sets.select("id", "keys"), 0)]
    found = components(_neighbours(sets, depth, 0, longs))
    settled = []
    while depth < p.deeper:
        size = found.groupBy("root").agg((F.count("*") + 1).alias("sets"))
        dense = stage(size.where(F.col("sets") > p.dense).select("root"), "dense")
        if not dense.take(1):
            break
        settled.append(found.join(dense, "root", "left_anti").select("u", "root"))
        inside = stage(_members(found).join(dense, "root", "left_semi").select("id"), "inside")
        depth = p.below(depth)
        if depth > 8 * longs:
            longs, grown, orders = -(-depth // 8), 0, []
        else:
            orders = [(x.join(inside, "id", "left_semi"), first) for x, first in orders]
        if p.trees(depth) > grown:
            fresh = _signed(rows.join(inside, "id", "left_semi"), p, grown, p.trees(depth), longs)
            orders.append((stage(fresh.dropDuplicates(["id"]).select("id", "keys"), "orders"), grown))
            grown = p.trees(depth)
        edges = [_neighbours(x, depth, first, longs) for x, first in orders]
        found = components(reduce(DataFrame.unionByName, edges))
    return reduce(DataFrame.unionByName, [found, *settled])


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every node of undirected ``edges`` (u, v): the smallest node reachable.
    Alternating large-star and small-star steps; each is one aggregation and one join, staged."""
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u <> v").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = stage(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).where("u <> v").distinct())
        small = stage(small, "small")
        # done when every node hangs on one root that hangs on nothing
        roots = small.select(F.col("v").alias("u")).distinct()
        open_ = (small.groupBy("u").count().where("count > 1").select("u").limit(1)
                 .unionByName(small.join(roots, "u", "left_semi").select("u").limit(1)))
        done = not open_.take(1)
        unstage(now)
        unstage(large)
        now = small
        if done:
            return now.withColumnRenamed("v", "root")


def linked_roots(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Per set the smallest index it reaches over links, decided on full sets. With ``side``
    (0/1 per set) only pairs across the sides are compared."""
    count = len(sets)
    root = np.arange(count)
    n = np.fromiter(map(len, sets), np.int64, count)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(count), n)
    order = np.argsort(flat, kind="stable")
    value, who = flat[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    post = np.diff(np.append(heads, len(value)))
    place = np.empty(len(flat), np.int64)
    place[order] = np.arange(len(value))
    ends = np.cumsum(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(count - 1):
        at = place[ends[i] - n[i]:ends[i]]
        rest = heads[group[at]] + post[group[at]] - at - 1  # postings of later sets
        at, rest = at[rest > 0], rest[rest > 0]
        if not len(at):
            continue
        inter = np.bincount(who[ragged(at + 1, rest)], minlength=count)
        j = np.flatnonzero(inter)
        hit = j[100 * inter[j] >= percent * (n[i] + n[j] - inter[j])]
        if side is not None:
            hit = hit[side[hit] != side[i]]
        for k in hit.tolist():
            x, y = find(i), find(k)
            if x != y:
                root[max(x, y)] = min(x, y)
    return np.array([find(i) for i in range(count)])


def _solve(p: Params):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("id").sort_values("id")
        ids, block = group["id"].to_numpy(), group["block"].to_numpy()
        b1, b2 = group["b1"].iloc[0], group["b2"].iloc[0]
        texts = [(t or "").encode() for t in group["t"]]
        sets: list[np.ndarray] = []
        for lo, hi in slices(map(len, texts), SLICE_BYTES):
            flat, n = shingles(texts[lo:hi], p.words)
            sets.extend(np.split(flat, np.cumsum(n)[:-1]))
        root = linked_roots(sets, p.percent, None if b1 == b2 else (block == b2).astype(int))
        off = root != np.arange(len(root))
        return pd.DataFrame({"u": ids[off], "v": ids[root[off]], "whole": group["blocks"].iloc[0] == 1})

    return run


def near_duplicates(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable over links), kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    signed = stage(_signed(rows, p, 0, p.trees(p.depth), 1), "signed")
    usable = signed.where("n > 0 and id is not null")
    # one node per distinct set; the copies collapse before the shuffle
    reps = stage(usable.groupBy("h1", "h2").agg(F.min(F.struct("id", "n", "keys")).alias("r"))
                 .select("h1", "h2", "r.id", "r.n", "r.keys"), "sets")
    regions = stage(_forest(rows, reps, p), "regions")

    members = _members(regions).join(reps.select("id", "n"), "id")
    blocks = members.groupBy("root").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS))
        .cast("int").alias("blocks"))
    members = stage(members.join(blocks, "root").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), "members")
    some = maybe_in(members.select("id"))  # most texts stand alone and need not move
    # a block meets itself and every other block of its region once
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = (rows.where(some(F.col("id"))).join(members, "id").select("root", "blocks", "block", "id", "t", other)
             .select("root", "blocks", "block", "id", "t", F.least("block", "other").alias("b1"),
                     F.greatest("block", "other").alias("b2")))
    links = stage(by_key(tasks, ["root", "b1", "b2"], _solve(p), "u long, v long, whole boolean"), "links")
    whole = links.where("whole").select("u", F.col("v").alias("root"))
    parts = links.where("not whole").select("u", "v")
    roots = whole.unionByName(components(parts)) if parts.take(1) else whole

    label = (reps.select("h1", "h2", F.col("id").alias("u")).join(roots, "u", "left")
             .select("h1", "h2", F.coalesce("root", "u").alias("component_id")))
    mine = signed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "h1", "h2")
    out = mine.join(label, ["h1", "h2"], "left").select(
        id_col, "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col(id_col).isNotNull(), F.col("component_id"))
        .otherwise(F.col(id_col)).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))


def keep(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with the columns it came with: the row of the
    smallest id (of repeated rows of one id, the first in column order)."""
    found = stage(near_duplicates(docs.select(id_col, text_col), p, id_col, text_col)
                  .select(id_col, "kept"), "kept")
    gone = found.where("not kept").select(id_col)
    some = maybe_in(gone)
    near = docs.where(some(F.col(id_col))).join(gone, id_col, "left_anti").select(docs.columns)
    out = docs.where(~some(F.col(id_col))).unionByName(near)
    again = stage(found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1")
                  .select(id_col), "again")
    if again.take(1):
        row = F.struct(*[F.col(c) for c in docs.columns])
        one = (out.join(again, id_col, "left_semi").select(id_col, row.alias("r"))
               .groupBy(id_col).agg(F.min("r").alias("r")).select("r.*"))
        out = out.join(again, id_col, "left_anti").select(docs.columns).unionByName(one)
    return out


def _members(regions: DataFrame) -> DataFrame:
    """(id, root) with the roots themselves."""
    return (regions.select(F.col("u").alias("id"), "root")
            .unionByName(regions.select(F.col("root").alias("id"), "root").distinct()))

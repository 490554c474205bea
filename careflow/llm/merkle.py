"""Merkle manifest of a dataset, as a persistent tree whose versions copy paths.

Every row is a leaf; the leaves of a group (a language) form a tree in the order of their ids,
and the groups' roots, in the groups' order, one more tree above them. A change to a leaf makes a
new version of the tree: the nodes from the leaf to the root are copied with new digests, and the
version shares every other node with the base. Versions never see each other's changes.

The tree is cut into aligned blocks of ``arity ** depth`` leaves. A task holds one block: it builds
the block's base nodes once, and path-copies the block's versions in that same node store. The
block roots are the leaves of the next, far smaller tree, cut into blocks alike, until every
group has one node. A block's way from its root to the top (the siblings on it, the same for all of
its versions) is joined to the block, and each version goes on over it, copying the upper nodes
only. So the work is dealt by blocks however large a group is: a group that holds a third of all
rows is so many blocks, and no task, shuffle key or driver variable holds a group.

Rows are numbered within their group by a range sort on (group, id, leaf), so texts are hashed where
they are read and only digests and ids move.

Defined cases: a NULL field counts as ``-``, an empty one as ``0:``; NULL groups are one group, the
first, and NULL ids the first of their group; repeated rows are leaves of their own, side by side,
and rows that share an id but differ come by leaf digest; a group of one row is its leaf; a
changed leaf that equals the old one (a NULL that stays NULL) is a version equal to the base; an
empty table gives no rows; columns beside the fields are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.common import stage

STEPS = "array<struct<l:string,r:string>>"  # siblings left and right of a node, upwards


@dataclass(frozen=True)
class Params:
    arity: int = 2
    depth: int = 10  # levels in a block

    @property
    def block(self) -> int:
        return self.arity ** self.depth

    def levels(self, n: int) -> int:
        """The levels that a block of a tree of ``n`` nodes raises its own nodes by."""
        height, width = 0, 1
        while width < n and height < self.depth:
            height, width = height + 1, width * self.arity
        return height


def encoded(*fields: Column) -> Column:
    """Fields as text: ``-`` for NULL, else the UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                      for t in texts])


def _hash(content: bytes) -> bytes:
    return sha256(content).hexdigest().encode()


class PathCopyTree:
    """The nodes of one block in all of its versions; a version is the id of its root."""

    def __init__(self, leaves: Sequence[bytes], levels: int, arity: int):
        self.digest, self.children = list(leaves), [()] * len(leaves)
        self.levels, self.arity = levels, arity
        ids = list(range(len(leaves)))
        for _ in range(levels):
            ids = [self._add(tuple(ids[a:a + arity])) for a in range(0, len(ids), arity)]
        (self.base,) = ids

    def _add(self, children: tuple[int, ...]) -> int:
        self.digest.append(_hash(b"".join([self.digest[c] for c in children])))
        self.children.append(children)
        return len(self.digest) - 1

    def _way(self, version: int, leaf: int) -> list[tuple[tuple[int, ...], int]]:
        """(children, place among them) at every node from the root down to a leaf."""
        out, node = [], version
        for level in reversed(range(self.levels)):
            place = leaf // self.arity ** level % self.arity
            out.append((self.children[node], place))
            node = self.children[node][place]
        return out

    def steps(self, version: int, leaf: int) -> list[tuple[bytes, bytes]]:
        """The digests left and right of a leaf's way, upwards."""
        d = self.digest
        return [(b"".join([d[c] for c in children[:at]]), b"".join([d[c] for c in children[at + 1:]]))
                for children, at in reversed(self._way(version, leaf))]

    def edit(self, version: int, leaf: int, digest: bytes) -> tuple[int, list[bytes]]:
        """A new version with ``digest`` at ``leaf``, and its new inner nodes, upwards."""
        way = self._way(version, leaf)
        self.digest.append(digest)
        self.children.append(())
        node, first = len(self.digest) - 1, len(self.digest)
        for children, at in reversed(way):
            node = self._add((*children[:at], node, *children[at + 1:]))
        return node, self.digest[first:]


def climb(digest: bytes, steps: Sequence[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes above ``digest`` along ``steps``, upwards."""
    out = []
    for left, right in steps:
        digest = _hash(left + digest + right)
        out.append(digest)
    return out


def _struct_lists(batch: pa.RecordBatch, column: str) -> Iterator[pa.StructArray]:
    for cell in batch[column]:
        yield cell.values


def _numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add idx, the row's place in its group ``g``, and n, the group's rows."""
    placed = stage(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                   .withColumn("pid", F.spark_partition_id())
                   .withColumn("mid", F.monotonically_increasing_id()), name)
    # One row per partition, and one more per group.
    spans = placed.groupBy("g", "pid").agg(F.count(F.lit(1)).alias("c"), F.min("mid").alias("first"))
    group = Window.partitionBy("g")
    before = group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("g", "pid", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"),
                         F.sum("c").over(group).alias("n"))
    return (placed.join(spans, ["g", "pid"])
            .withColumn("idx", F.col("start") + F.col("mid") - F.col("first"))
            .drop("pid", "mid", "first", "start"))


def _blocks(nodes: DataFrame, p: Params, *content: str) -> DataFrame:
    """One row per block: g, n, block and its nodes in order (at most ``p.block``)."""
    return (nodes.withColumn("block", F.expr(f"idx div {p.block}")).groupBy("g", "n", "block")
            .agg(F.sort_array(F.collect_list(F.struct("idx", *content))).alias("nodes")))


def _ways(nodes: DataFrame, most: int, p: Params, name: str) -> DataFrame:
    """(g, idx, steps, top): every node's way to its group's top, from nodes (g, n, idx, h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, n, block, rows in zip(*(batch[c].to_pylist() for c in ("g", "n", "block")),
                                         _struct_lists(batch, "nodes")):
                tree = PathCopyTree([h.encode() for h in rows.field("h").to_pylist()], p.levels(n), p.arity)
                ways = [[(left.decode(), right.decode()) for left, right in tree.steps(tree.base, k)]
                        for k in range(len(rows))]
                size = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * size), pa.array([n] * size, pa.int64()), pa.array([block] * size, pa.int64()),
                     rows.field("idx"),
                     pa.array([[{"l": a, "r": b} for a, b in w] for w in ways],
                              pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))),
                     pa.array([tree.digest[tree.base].decode()] * size)],
                    ["g", "n", "block", "idx", "steps", "top"])

    inside = stage(_blocks(nodes, p, "h").mapInArrow(
        run, f"g string, n long, block long, idx long, steps {STEPS}, top string"), name)
    if most <= p.block:
        return inside.select("g", "idx", "steps", "top")
    upper = inside.where(F.col("idx") % p.block == 0).select(
        "g", F.expr(f"(n + {p.block - 1}) div {p.block}").alias("n"), F.col("block").alias("idx"), F.col("top").alias("h"))
    above = _ways(upper, -(-most // p.block), p, name + "-up").select(
        "g", F.col("idx").alias("block"), F.col("steps").alias("more"), F.col("top").alias("tip"))
    return inside.join(above, ["g", "block"]).select("g", "idx", F.concat("steps", "more").alias("steps"),
                                                     F.col("tip").alias("top"))


def manifest(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """The tree over ``rows`` (id, grp, leaf, edit) and a version for each row with an edit.

    ``edit`` is a changed leaf digest or NULL. Per row: id, leaf, subroot, root, proof (the
    siblings' digests, upwards), copies (the version's new nodes, upwards; NULL without edit) and
    folded_root: the root of the row's version, or, without one, the root recomputed from the leaf
    and its siblings."""
    ident = rows.schema["id"].dataType.simpleString()
    kind = f"id {ident}, leaf string, subroot string, root string, proof string, copies string, folded_root string"
    group = F.when(F.col("grp").isNull(), "").otherwise(F.concat(F.lit("="), F.col("grp").cast("string")))
    leaves = stage(rows.select(group.alias("g"), "id", "leaf", "edit"), "leaves")
    numbered = _numbered(leaves, ["id", "leaf"], "numbered")
    blocks = stage(_blocks(numbered, p, "id", "leaf", "edit"), "blocks")
    most = blocks.agg(F.max("n")).first()[0]
    if most is None:
        return rows.sparkSession.createDataFrame([], kind)

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for n, nodes in zip(batch["n"].to_pylist(), _struct_lists(batch, "nodes")):
                tree = PathCopyTree([h.encode() for h in nodes.field("leaf").to_pylist()], p.levels(n), p.arity)
                tops.append(tree.digest[tree.base].decode())
            yield pa.RecordBatch.from_arrays([batch["g"], batch["n"], batch["block"], pa.array(tops, pa.string())],
                                             ["g", "n", "block", "h"])

    tops = blocks.mapInArrow(roots, "g string, n long, block long, h string").select(
        "g", F.expr(f"(n + {p.block - 1}) div {p.block}").alias("n"), F.col("block").alias("idx"), "h")
    ways = _ways(tops, -(-most // p.block), p, "ways")
    subroots = _numbered(ways.where("idx = 0").select(F.lit("").alias("g"), F.col("g").alias("name"),
                                                      F.col("top").alias("h")), ["name"], "subroots")
    groups = subroots.agg(F.max("n")).first()[0]
    over = (_ways(subroots.select("g", "n", "idx", "h"), groups, p, "root").drop("g")
            .join(subroots.select("idx", F.col("name").alias("g")), "idx")
            .select("g", F.col("steps").alias("over"), F.col("top").alias("root")))
    whole = (blocks.join(ways.withColumnRenamed("idx", "block"), ["g", "block"]).join(over, "g")
             .select("n", "nodes", "steps", "over", F.col("top").alias("subroot"), "root"))

    def versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, nodes in enumerate(_struct_lists(batch, "nodes")):
                n, steps, over, subroot, root = (batch[c][at].as_py() for c in ("n", "steps", "over", "subroot", "root"))
                upper = [(x["l"].encode(), x["r"].encode()) for x in steps + over]
                beyond = "".join([x["l"] + x["r"] for x in steps + over])
                leaves = [h.encode() for h in nodes.field("leaf").to_pylist()]
                tree = PathCopyTree(leaves, p.levels(n), p.arity)
                proofs, copies, folded = [], [], []
                for k, edit in enumerate(nodes.field("edit").to_pylist()):
                    way = tree.steps(tree.base, k)
                    proofs.append(b"".join([left + right for left, right in way]).decode() + beyond)
                    if edit is None:
                        top = [leaves[k], *climb(leaves[k], way + upper)][-1]
                        copies.append(None)
                    else:
                        version, new = tree.edit(tree.base, k, edit.encode())
                        new += climb(tree.digest[version], upper)
                        top = (new or [tree.digest[version]])[-1]
                        copies.append(b"".join(new).decode())
                    folded.append(top.decode())
                size = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [nodes.field("id"), nodes.field("leaf"), pa.array([subroot] * size), pa.array([root] * size),
                     *[pa.array(x, pa.string()) for x in (proofs, copies, folded)]],
                    ["id", "leaf", "subroot", "root", "proof", "copies", "folded_root"])

    return whole.mapInArrow(versions, kind)


def leaf_digests(docs: DataFrame, fields: Sequence[str], id_col: str, group_col: str,
                 edits: dict[str, Column], edited: Column) -> DataFrame:
    """(id, grp, leaf, edit) of every row: the digest of its ``fields`` in their order, and, where
    ``edited`` holds, the digest with the columns in ``edits`` put in their places."""
    changed = encoded(*[edits.get(f, F.col(f)) for f in fields])
    return docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
                       F.sha2(encoded(*[F.col(f) for f in fields]), 256).alias("leaf"),
                       F.when(edited, F.sha2(changed, 256)).alias("edit"))

"""Merkle manifest: trees against a recursive definition, shared nodes of versions, odd rows."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careflow.llm import merkle, queries
from careflow.llm.merkle import Params, PathCopyTree, climb


def H(x):
    return sha256(x.encode()).hexdigest()


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([H("".join(last[k:k + arity])) for k in range(0, len(last), arity)])
    return out


def way(tree, at, arity):
    """Siblings of node ``at``, upwards: (left, right) texts."""
    out = []
    for level in tree[:-1]:
        a = at // arity * arity
        run = level[a:a + arity]
        out.append(("".join(run[:at - a]), "".join(run[at - a + 1:])))
        at //= arity
    return out


def leaf(row, more=0):
    row = [*row[:3], None if row[3] is None else row[3] + more, row[4]]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text); the contract's columns, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]], arity)
    top = levels([trees[g][-1][0] for g in names], arity)
    out = []
    for k, g in enumerate(names):
        for at, r in enumerate(groups[g]):
            steps = way(trees[g], at, arity) + way(top, k, arity)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, int(tampered))
            for left, right in steps:
                h = H(left + h + right)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], H("".join(a + b for a, b in steps)), h,
                        h == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, id string, g int"


def run(spark, rows, p):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    made = merkle.leaf_digests(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "lang",
                               {"n_chars": more}, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return merkle.manifest(made, p)


def digests(df):
    return sorted(map(tuple, df.select(
        "id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root",
        F.col("folded_root") == F.col("root")).collect()), key=repr)


def rows_of(sizes):
    out, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            out.append((n * 37 % 1009, f"s{n % 3}", lang, n, f"text {n} é"))
            n += 1
    return out


@pytest.mark.parametrize("p, sizes", [
    (Params(2, 2), {"en": 23, "de": 1, "fr": 4, "es": 5, None: 9, "": 3, "é": 2, "z": 64}),
    (Params(3, 1), {"en": 28, "de": 2, "b": 1}),
    (Params(2, 10), {"en": 40, "de": 7, "fr": 33}),
    (Params(2, 10), {"en": 1}),
    (Params(2, 3), {None: 8}),
])
def test_equal_to_the_definition(spark, p, sizes):
    rows = rows_of(sizes)
    assert digests(run(spark, rows, p)) == brute(rows, p.arity)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "s", "en", 1, "null id"), (None, "s", "en", 2, "null id"),
            (5, "s", "en", 3, ""), (5, "s", "en", 3, ""), (5, "s", "en", 3, "differs"), (7, "", "", 0, "x" * 300_000),
            (2**53 + 1, "s", "en", 2**63 - 1, "largest"), (2**63 - 1, "s", "en", 4, "\x00\n:")]
    rows += [(i, "s", "en", None if i % 2 else i, "t") for i in range(10, 60)]  # tampered NULLs stay
    got = digests(run(spark, rows, Params(2, 2)))
    assert got == brute(rows)
    assert any(not x[-1] for x in got)


def test_empty_table(spark):
    assert run(spark, [], Params()).collect() == []


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 30), st.integers(2, 4), st.data())
def test_versions_share_untouched_nodes(n, arity, data):
    p = Params(arity, 5)
    leaves = [H(str(k)).encode() for k in range(n)]
    tree = PathCopyTree(leaves, p.levels(n), arity)
    versions = {tree.base: list(leaves)}
    for step in range(data.draw(st.integers(0, 6))):
        base, at = data.draw(st.sampled_from(sorted(versions))), data.draw(st.integers(0, n - 1))
        before = len(tree.digest)
        new = H(f"new {step}").encode()
        version, nodes = tree.edit(base, at, new)
        assert len(tree.digest) - before == p.levels(n) + 1 and len(nodes) == p.levels(n)
        versions[version] = [*versions[base][:at], new, *versions[base][at + 1:]]
    for version, held in versions.items():
        want = levels([h.decode() for h in held], arity)
        assert tree.digest[version].decode() == want[-1][0]
        for at in range(n):
            steps = tree.steps(version, at)
            assert [(a.decode(), b.decode()) for a, b in steps] == way(want, at, arity)
            assert [held[at], *climb(held[at], steps)][-1] == tree.digest[version]


def test_copies_are_the_nodes_of_the_versions(spark):
    rows = rows_of({"en": 21, "de": 6})
    for r in run(spark, rows, Params(2, 2)).collect():
        if r["copies"] is None:
            assert r["folded_root"] == r["root"]
        else:
            assert r["copies"].endswith(r["folded_root"]) and len(r["copies"]) % 64 == 0


def test_query_equals_the_definition(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = sorted(map(tuple, queries.op11_merkle_manifest(spark, sf).collect()), key=repr)
    assert got == brute(list(map(tuple, docs.collect())))

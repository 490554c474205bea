"""Token counts, packing and n-best segmentation against the libraries and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from careflow.llm import bpe, nbest, packing

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["'s", "'ll", "'", "’", " ", "  ", "\n", "\t", "a", "bc", "É", "ß", "日本", "1", "٣", "²", "<|endoftext|>", "_",
         "...", "\x1c", "\x85", " ", "😀", "‍", "aaaa", "don't", "I'd"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_ids_equal_the_library(library, monkeypatch):
    every = [*texts(3000, 1), None, "", "x" * 5000, "ab" * 3000, "日" * 900]
    own = bpe.BytePairEncoder(BPE)
    for size in (bpe.SLICE_CHARS, 40):
        monkeypatch.setattr(bpe, "SLICE_CHARS", size)
        counts, flat = own.encode_flat(every)
        want = [e.ids for e in library.encode_batch([t or "" for t in every], add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want))
        assert flat.tolist() == [x for ids in want for x in ids]


def test_pre_tokens_of_every_character(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = ["".join(f"a{c}1{c} {c}" for c in points[k:k + 400]) for k in range(0, len(points), 400 * 12)]
    counts, _ = bpe.encoder(BPE).encode_flat(every, ids=False)
    assert counts.tolist() == [len(e.ids) for e in library.encode_batch(every, add_special_tokens=False)]


def test_token_counts_of_rows(spark, library):
    data = [(i, t, "x") for i, t in enumerate(texts(200, 2))] + [(None, "a b", "x"), (1, None, "x"), (1, None, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, n_tokens string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in bpe.token_counts(df, BPE, 10).collect())
    want = sorted((i is None, i or 0, len((t or "").encode()), n, n > 10) for i, t, _ in data
                  for n in [len(library.encode(t or "", add_special_tokens=False).ids)])
    assert got == want
    assert bpe.token_counts(df.where("false"), BPE, 10).count() == 0


def check_packing(rows, data, library, capacity):
    left = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    want = []
    for i, t in data:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(i is None, i or 0, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert left == sorted(want)
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_round_trip(spark, library):
    rng = random.Random(4)
    data = [(i, "word " * rng.randint(0, 90)) for i in range(300)] + [
        (400, "long " * 700), (401, None), (402, ""), (None, "no id"), (7, "again"), (7, "again")]
    df = spark.createDataFrame([(i, t, "z") for i, t in data], "doc_id long, text string, bin string")
    p = packing.Params(capacity=64, shard_items=60)
    rows = packing.pack(df, BPE, p).collect()
    n = check_packing(rows, data, library, 64)
    assert n <= -(-sum(r["length"] for r in rows) // 64) + 4
    assert packing.pack(df.where("false"), BPE, p).count() == 0


def test_island_never_gets_worse_than_best_fit():
    sizes = np.sort(np.random.default_rng(2).integers(500, 1100, 800))[::-1].copy()
    island = packing.Island(sizes, packing.Params(), 1)
    start = island.fresh(0.0)
    pool = island.evolve([start])
    for _ in range(2):
        pool = island.evolve(pool)
    assert island.value(pool[0]) > island.value(start)
    assert island.fills(pool[0]).max() <= 2048 and island.fills(pool[0]).sum() == sizes.sum()


def all_segmentations(lattice, text, n):
    best = [[(0.0, ())]] + [[] for _ in text]
    for j in range(1, len(text) + 1):
        found = {}
        for size in range(1, min(lattice.longest, j) + 1):
            piece = text[j - size:j]
            if piece in lattice.by_text:
                i = lattice.by_text[piece]
                step, ids = float(lattice.score[i]), (i,)
            elif size == 1:
                step, ids = lattice.no_piece, tuple(lattice.spelled(piece))
            else:
                continue
            found |= {(s + step, x + ids): 0 for s, x in best[j - size]}
        best[j] = sorted(found, key=lambda x: -x[0])[:3 * n]
    return [s for s, _ in best[len(text)][:n]]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_n_best_equals_brute_force(n):
    lattice = nbest.lattice(PIECES)
    rng = random.Random(n)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "日", "😀", "xyz", ".", "=="]
    every = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(200)] + ["x" * 60 + "the" * 20, ""]
    normal = [lattice.normalize(t) for t in every]
    for text, found in zip(normal, nbest.segmentations(lattice, normal, n)):
        assert [s for s, _ in found] == all_segmentations(lattice, text, n)
        assert len({tuple(ids) for _, ids in found}) == len(found)
        assert all(lattice.decode(ids) == text.replace(nbest.MARK, " ") for _, ids in found)


def test_n_best_rows(spark):
    data = [(1, "Hello world", 9.0), (1, "Hello world", 9.0), (2, None, 9.0), (3, "", 9.0), (None, "x", 9.0), (4, "ab " * 30000, 9.0)]
    df = spark.createDataFrame(data, "doc_id long, text string, score double")
    rows = nbest.n_best(df, PIECES, 3).collect()
    empty = [r for r in rows if r["doc_id"] in (2, 3)]
    assert len(empty) == 2 and all(r["n_pieces"] == 0 and r["score"] == 0 for r in empty)
    assert all(r["decodes"] for r in rows)
    twice = sorted((r["rank"], r["ids_crc32"]) for r in rows if r["doc_id"] == 1)
    assert len(twice) == 6 and twice[::2] == twice[1::2]
    assert nbest.n_best(df.where("false"), PIECES, 3).count() == 0


def test_n_best_rank_1_is_the_library_encoding(spark):
    tool = nbest.lattice(PIECES)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    whole = [r["text"] for r in docs.orderBy("doc_id").limit(150).collect()]
    rng = random.Random(8)
    parts = ["a", "the", "Hello world", "ing", " ", "  ", "\n", "\t", "é", "日本", "😀", "<s>", "<0x41>", nbest.MARK, "\x00", "xyz", "=="]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(500)] + ["ab" * 30000, " ", ""]
    for every in (whole, odd):
        every = [t or "" for t in every]
        normal = [tool.normalize(t) for t in every]
        plain = nbest.segmentations(tool, normal, 3)
        for text, found, by_score in zip(every, nbest.segmentations(tool, normal, 3, library=True), plain):
            ids = tool.sp.encode(text)
            assert found[0][1].tolist() == ids
            assert tool.sp.decode(found[0][1].tolist()) == tool.sp.decode(ids)
            assert [x.tolist() for _, x in found[1:]] == [x.tolist() for _, x in by_score if x.tolist() != ids][:2]
    rows = nbest.n_best(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), PIECES, 3).where("rank = 1").collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in rows} == {
        i: zlib.crc32(np.array(tool.sp.encode(t), "<u4").tobytes()) for i, t in enumerate(odd)}
    assert all(r["decodes"] for r in rows)

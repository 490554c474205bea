"""Fill-in-the-middle: marks and cuts against the token pattern, exact round trips, odd rows."""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from careflow.llm import fill_middle
from careflow.llm.fill_middle import Params, Units

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, p=Params()):
    """The transformation, one row at a time, from the token pattern."""
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digest = sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= p.fim_percent:
        return doc_id, len(tokens), "plain", None, None, text
    if h[3] % 100 < p.spm_percent:
        return doc_id, len(tokens), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(tokens), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


CHARS = st.text(st.sampled_from(" \t\n\x0b\x0c\r\x08\x0e\x1f!a\x7f\x80\x85\xa0é 世😀<PSM>"), max_size=40)


@settings(deadline=None, max_examples=300)
@given(st.lists(CHARS, min_size=1, max_size=6))
def test_marks_and_cuts_follow_the_pattern(texts):
    units = Units([t.encode() for t in texts])
    for i, text in enumerate(texts):
        tokens = TOKEN.findall(text)
        assert units.n[i] == len(tokens)
        k = np.arange(len(tokens) + 1)
        ends = units.ends(np.full(len(k), i), k)
        heads = ["".join(tokens[:n]) for n in k]
        assert ends.tolist() == [len(h.encode()) for h in heads]
        assert units.chars_to(np.full(len(k), i), ends).tolist() == [len(h) for h in heads]


ODD = [(1, None, 7), (2, "", 7), (3, "   \t\n", 7), (4, "one", 7), (4, "one", 7), (None, "a null id has draws too", 7),
       (5, "holds a <M> marker in it", 7), (6, "<P<S" * 3 + " <<P >S> x", 7), (2**53 + 1, "big ids stay", 7),
       (7, "wide   signs: 世界 😀 é x  ", 7), (8, "word " * 60_000, 7), (9, " " * 5000 + "x" * 5000, 7)]
ODD += [(i, f"some more words for row {i} <", 7) for i in range(20, 220)]


def rows(spark, data, p=Params()):
    docs = spark.createDataFrame(data, "doc_id long, text string, output int")
    return fill_middle.transform(docs, p)


@pytest.mark.parametrize("p", [Params(), Params(seed=3, fim_percent=100, spm_percent=40)])
def test_rows_equal_brute_force_and_rebuild(spark, p):
    out = rows(spark, ODD, p).withColumn("back", fill_middle.restore())
    got = sorted(map(tuple, out.collect()), key=repr)
    want = sorted(((*brute(i, t, p), t or "") for i, t, _ in ODD), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_empty_table(spark):
    assert rows(spark, []).collect() == []


def test_slices_do_not_change_rows(spark, monkeypatch):
    whole = sorted(map(tuple, rows(spark, ODD).collect()), key=repr)
    cut = fill_middle._rows([i for i, _, _ in ODD], [(t or "").encode() for _, t, _ in ODD], Params())
    single = [fill_middle._rows([i], [(t or "").encode()], Params()) for i, t, _ in ODD]
    assert [x for s in single for x in s["output"]] == cut["output"]
    assert sorted(x[5].encode() for x in whole) == sorted(cut["output"])

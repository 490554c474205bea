"""Language ID, secrets, near-duplicates, toxicity and page text: brute force and held-out rows."""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pytest

from careflow.llm import language_id, near_dup, page_text, secret_scan, toxicity
from careflow.llm.common import fold

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(a, kind, b) for a, _, kind, b in sorted(out)]


def secret_texts(n, seed):
    rng = random.Random(seed)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", "api", "_", " ", "  ", "=", ":", "'", '"', "AKIA",
             "AKI", "A", "abcdef0123456789", "deadbeef", "ghp_", "xoxb-", "é", "日", ",", "\n", "x", "/+", "K9", "Z" * 12, "0" * 7]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_automaton_equals_regex_search():
    every = secret_texts(5000, 5)
    for text, (base, found) in zip(every, secret_scan.scanner().spans(every)):
        assert base == base_spans(text)
        assert set(base) <= set(found)


def test_automaton_is_minimal_and_small():
    a = secret_scan.scanner().forward
    assert a.n_states < a.n_subsets
    tables = {(int(f), *row) for f, row in zip(a.accept, a.step.reshape(-1, 256))}
    assert len(tables) == a.n_states


def test_secret_rows_and_masks(spark):
    data = [(i, t, 5, "s") for i, t in enumerate(secret_texts(200, 6))] + [(None, None, 5, "s"), (1, "", 0, "s"), (9, "f" * 90000, 1, "s")]
    df = spark.createDataFrame(data, "doc_id long, text string, n_chars long, spans string")
    rows = secret_scan.scan(df).collect()
    assert len(rows) == len(data)
    want = sorted((str(i), [len([x for x in base_spans(t or "") if x[1] == k]) for k in ("assign", "access", "hex")],
                   hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in base_spans(t or "")).encode()).hexdigest()) for i, t, *_ in data)
    assert sorted((str(r["doc_id"]), [r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"]) for r in rows) == want
    masked = secret_scan.mask(df)
    assert masked.columns == df.columns
    for r in masked.collect():
        assert not base_spans(r["text"] or "") or "<" in r["text"]
    assert secret_scan.mask(spark.createDataFrame([(1, "a password=0123456789ab b", 25, "s")], df.schema)).first()[:3] == (1, "a <assign> b", 12)
    assert secret_scan.scan(df.where("false")).count() == 0


def word_sets(rows, words):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out.append(frozenset(zip(*[w[k:] for k in range(words)])) if len(w) >= words else frozenset([tuple(w)]) if w else frozenset())
    return out


def brute_components(rows, p):
    sets = word_sets(rows, p.words)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                inter = len(a & sets[j])
                if 100 * inter >= p.percent * (len(a) + len(sets[j]) - inter):
                    root[find(i)] = find(j)
    least: dict = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[find(i)] = min(least.get(find(i), ident), ident)
    return sorted((str(ident), len(s), least.get(find(i)) if ident is not None else None) for i, ((ident, _), s) in enumerate(zip(rows, sets)))


def copies(seed):
    """Families of near copies around the threshold, exact copies, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(string.ascii_letters) for _ in range(4)) for _ in range(400)]
    rows, ident = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 14)):
            now = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
            rows.append((ident := ident + rng.randint(1, 3), rng.choice([" ", "\n", " \t "]).join(now)))
    rng.shuffle(rows)
    return rows + [(9001, None), (9002, ""), (9003, " \n "), (9004, "one"), (9005, "ONE"), (None, "one"), (9004, "one"), (9006, "a b c")]


@pytest.mark.parametrize("params", [
    near_dup.Params(words=3, percent=85), near_dup.Params(),
    near_dup.Params(words=3, percent=85, dense=3, deeper=7), near_dup.Params(words=3, percent=85, dense=3)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, params):
    rows = copies(params.words)
    df = spark.createDataFrame([(i, t, 1, True) for i, t in rows], "doc_id long, text string, n long, kept boolean")
    want = brute_components(rows, params)
    for sets in (near_dup.BLOCK_SETS, 4):  # one task per region, and blocks
        monkeypatch.setattr(near_dup, "BLOCK_SETS", sets)
        got = near_dup.near_duplicates(df, params).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == want
        assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    kept = near_dup.keep(df, params)
    assert kept.columns == df.columns
    roots = {c for i, _, c in want if i != "None"}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([*map(str, roots), "None"])


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(df).count() == 0 and near_dup.keep(df).count() == 0


def test_common_prefix_counts_leading_bytes():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (500, 16)).astype(np.uint8)
    y = x.copy()
    for row, at in zip(y, rng.integers(0, 17, 500)):
        row[at:] = rng.integers(0, 2, 16 - at)
    want = [next((k for k in range(16) if a[k] != b[k]), 16) for a, b in zip(x, y)]
    longs = [np.ascontiguousarray(z).view(">u8").astype(np.int64) for z in (x, y)]
    assert near_dup.common_prefix(*longs).tolist() == want


def test_signatures_are_prefixes_and_agree_as_sets_do():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    near = np.concatenate([base[:90], rng.integers(0, 2**63, 10, dtype=np.uint64)])
    flat, n = np.concatenate([np.sort(base), np.sort(near)]), np.array([100, 100])
    short, long = (near_dup.signatures(flat, n, 0, 400, longs, 20) for longs in (1, 2))
    assert (short[:, :, 0] == long[:, :, 0]).all()
    assert (near_dup.signatures(flat, n, 7, 9, 1, 20) == short[:, 7:9]).all()
    same = near_dup.common_prefix(short[0], short[1])
    assert abs((same >= 1).mean() - 90 / 110) < 0.08 and abs((same >= 6).mean() - (90 / 110) ** 6) < 0.08


def test_near_duplicates_of_very_long_texts(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    near = words[:-2000] + [f"x{k}" for k in range(2000)]
    far = words[:30_000] + [f"y{k}" for k in range(30_000)]
    df = spark.createDataFrame([(2**53 + 1, " ".join(words)), (None, " ".join(words)), (2**53 + 3, " ".join(near)), (7, " ".join(far))],
                               "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df).collect()}
    assert got == {2**53 + 1: (2**53 + 1, True), 2**53 + 3: (2**53 + 1, False), 7: (7, True), None: (None, True)}


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (203, 201), (300, 300)]
    got = dict(near_dup.components(spark.createDataFrame(chain, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 201: 200, 203: 200}


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_rows(spark):
    data = [(1, "the cat sat on the mat and the dog", "en", 1), (2, "der hund und die katze und das haus", "de", 1), (3, None, "de", 1),
            (4, "", None, 1), (5, "123 !?", None, 1), (None, "the dog and the cat", "en", 1), (6, "der hund und das haus " * 3000, None, 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score long")
    model = language_id.learn(df)
    got = {r["doc_id"]: r for r in language_id.predict(df, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6)] == ["en", "de", "und", "und", "und", "de"]
    assert got[5]["score"] == 0 and not got[5]["accepted"] and got[6]["accepted"]
    assert language_id.keep(df, model).columns == df.columns
    assert language_id.keep(df, language_id.learn(df.where("false"))).count() == len(data)
    assert language_id.identify(df.where("false")).count() == 0
    alone = language_id.predict(df, language_id.learn(df.where("lang = 'de'"))).where("lang_pred = 'de'")
    assert alone.count() == 4


def test_language_ties_repeats_and_slack(spark):
    same = "one text of both languages"
    data = [(1, same, "xx"), (2, same, "aa"), (3, same, "xx"), (3, same, "xx"), (2**53 + 1, same, None), (None, same, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.learn(df)
    assert model.langs == ("xx", "aa")  # more rows first: the tie goes to it
    rows = language_id.predict(df, model).collect()
    assert len(rows) == len(data) and len({(r["lang_pred"], r["score"], r["margin"], r["accepted"]) for r in rows}) == 1
    assert rows[0]["lang_pred"] == "xx" and not rows[0]["accepted"]
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 2**53 + 1, None}
    rng = random.Random(9)
    parts = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat"]) for _ in range(20)) for _ in range(80)]
    few, many = (dict(language_id._bound(parts[:k], 2000)) for k in (4, 80))
    assert few and many and max(few.values()) > max(many.values())
    assert language_id._bound(parts[:1], 2000) == ()


def test_language_rejects_what_was_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.learn(docs, usable=fold("doc_id", 5) != 0)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9)))
    kinds = {n: [" ".join(word() for _ in range(n)) for _ in range(200)] for n in (5, 10, 20, 40, 400)}
    kinds["cjk"] = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(10)) for _ in range(50)]
    rows = spark.createDataFrame([(str(k), t) for k, texts in kinds.items() for t in texts], "kind string, text string")
    kept = {k: 0 for k in map(str, kinds)} | {r["kind"]: r["count"] for r in language_id.keep(rows, model).groupBy("kind").count().collect()}
    assert kept["cjk"] == 0 and all(kept[str(n)] <= 30 for n in (5, 10, 20, 40, 400)), kept
    held = docs.where(fold("doc_id", 5) == 0)
    assert language_id.keep(held, model).count() >= 0.97 * held.count()


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"  # in the smaller tables only a few dozen rows are toxic
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.05


def test_toxicity_of_unseen_misspellings():
    rng = random.Random(1)
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(300)]
    clean = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(400)]
    insults = ["pathetic", "worthless", "disgusting"]
    toxic = [c.replace(" ", f" {rng.choice(insults)} ", 1) for c in clean[:200]]
    model = toxicity.train(clean + toxic, [0] * 400 + [1] * 200)
    scores = model.scores([clean[0], clean[1] + " patheticc", clean[2] + " worthlesss", None, "", "x" * 100000])
    assert scores[1] > 0.3 and scores[2] > 0.3 and scores[0] < 0.3 and scores[3] == scores[4] < 0.3


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(300)]
    long = lambda: [rng.choice(words) for _ in range(4000)]  # noqa: E731  24,000 characters
    data = []
    for i in range(30):
        text = long()
        if i % 3 == 0:
            text[(0, 2000, 3999)[i // 3 % 3]] = "worthless"
        data.append((i, " ".join(text), int(i % 3 == 0)))
    docs = spark.createDataFrame([x[:2] for x in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in data], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels, held=-1)
    order = [r["doc_id"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id, 5) AS h").orderBy("h").collect()]
    whole = toxicity.train([data[i][1] for i in order], [data[i][2] for i in order])
    assert np.array_equal(model.scalars, whole.scalars) and model.bias == whole.bias
    assert (model.scores([t for _, t, y in data if y]) >= 0.3).all()
    one = toxicity.Params(class_chars=1)  # one whole text per class
    firsts = {next(i for i in order if data[i][2] == y) for y in (0, 1)}
    few = toxicity.train([data[i][1] for i in order if i in firsts], [data[i][2] for i in order if i in firsts], one)
    assert np.array_equal(toxicity.learn(docs, labels, held=-1, p=one).scalars, few.scalars)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (None, "c", "x")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, 0, 1)], none.schema)
    for labels in (none, odd):
        rows = toxicity.classify(docs, labels).collect()
        assert len(rows) == 3 and all(r["predicted"] == 0 for r in rows)
    assert toxicity.classify(docs.where("false"), none).count() == 0
    assert toxicity.keep(docs, toxicity.train([], []), 0.4).columns == docs.columns


def test_page_text_of_labelled_pages():
    model = page_text.train(page_text.labelled_pages(400, 4))
    right = total = 0
    for found, labels in page_text.labelled_pages(150, 77):
        scores = [sum(model.weights.get(f, 0.0) for f in page_text.path_features(b.path) + page_text.text_features(b)) for b in found]
        right += sum(x == y for x, y in zip(model.viterbi(scores), labels))
        total += len(labels)
    assert right / total > 0.98


def test_viterbi_is_the_best_chain():
    model = page_text.Model({}, ((0.4, -0.7), (-0.2, 0.9)), (0.1, -0.3), (0.5, 0.2))
    rng = random.Random(2)
    for _ in range(50):
        scores = [rng.gauss(0, 1) for _ in range(rng.randint(1, 7))]

        def value(labels):
            out = model.begin[labels[0]] + model.end[labels[-1]] + sum(s for s, y in zip(scores, labels) if y)
            return out + sum(model.change[a][b] for a, b in zip(labels, labels[1:]))

        every = [[k >> t & 1 for t in range(len(scores))] for k in range(1 << len(scores))]
        assert value(model.viterbi(scores)) == pytest.approx(max(map(value, every)))


def test_page_blocks_of_broken_markup():
    text = lambda page: [b.text for b in page_text.blocks(page)]
    assert text("<p>a<p>b<b>c</b>d<br>e &amp; f&nbsp;g</p>tail &copy") == ["a", "bcd e & f g", "tail ©"]
    assert text('<script>var t="</p>";x</script><!-- <p>no</p> --><div title="a>b">yes</div><style>p{}') == ["yes"]
    assert text("") == [] and text("plain") == ["plain"] and text("a<b") == ["a"]
    assert [b.path for b in page_text.blocks("<ul><li>a<li>b</ul><div class='x Ad-Box' id=q>c")] == [
        ("ul", "li"), ("ul", "li"), ("div ad box q x",)]


def test_page_rows(spark):
    data = [(1, "u", "<nav><a>m</a></nav><article><h1>T</h1><p>One &lt; two.</p></article><footer>&copy; x</footer>", "t"),
            (2, "u", None, "t"), (3, None, "", "t"), (3, None, "", "t"), (4, "u", "<article>" + "<p>word. </p>" * 20000 + "</article>", "t")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    got = sorted(page_text.extract(df).select("page_id", "text", "n_chars").collect())
    assert [tuple(r) for r in got[:4]] == [(1, "T One < two.", 12), (2, "", 0), (3, "", 0), (3, "", 0)]
    assert got[4]["n_chars"] == 6 * 20000 - 1
    assert page_text.extract(df.where("false")).count() == 0


def test_shingling_keeps_small_tables(monkeypatch):
    """A worker lives through all stages of the pipeline: what it keeps of one must stay small."""
    from careflow.llm import common, near_dup

    monkeypatch.setattr(common, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    texts = [b"abcdefg " * 250] * 2000
    whole, n = [], []
    for lo, hi in common.slices(map(len, texts), near_dup.SLICE_BYTES):
        sets, size = near_dup.shingles(texts[lo:hi], 3)
        whole.append(sets)
        n.append(size)
    assert np.concatenate(n).tolist() == [1] * len(texts) and len(set(np.concatenate(whole).tolist())) == 1
    assert sum(x.nbytes for x in common._POWERS) <= 8 << 20

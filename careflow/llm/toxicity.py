"""Toxicity by subword-bag embeddings: a linear softmax over averaged character n-gram vectors,
embeddings and output layer trained jointly in numpy.

A word is the bag of its marked character n-grams, so misspellings share most vectors with the
words seen in learning. The average is taken over windows of words, and a text is as toxic as
its most toxic window: a short insult in a long text is not averaged away. Training takes, per
text, the window that scores highest at that step.

Learning reads a bounded sample of whole texts: per class the rows with the smallest key hash, at
most ``Params.rows_per_class`` and, after the first, only while their texts together stay within
``Params.class_chars`` characters. Tasks turn texts into word numbers and their distinct words,
and only these reach the driver. Scoring reads every whole text.

Defined cases: NULL and empty text get the score of an empty bag (the bias); with no learnable
row, or one class only, every score is the class share (0 without rows); repeated label rows of
one key count once, toxic if any says so; NULL labels are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import RangeHash, fold, mix64, ragged, slices

SLICE_BYTES = 1 << 21
TOXIC_FROM = 0.3  # the score from which a text counts as toxic
_LETTER = np.zeros(256, bool)  # bytes of a word: ASCII letters, digits and all non-ASCII bytes
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Params:
    rows_per_class: int = 1200
    class_chars: int = 12_000_000
    buckets: int = 1 << 17
    dim: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    window: int = 3
    epochs: int = 40
    rate: float = 0.3
    decay: float = 2e-6
    seed: int = 7


class Bag:
    """Words of a slice of texts and the n-gram buckets of each (unique) word."""

    def __init__(self, texts: list[bytes], p: Params):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        data = _LOWER[data]
        inside = _LETTER[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.starts, self.ends = edge[::2], edge[1::2]
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        self.first = np.searchsorted(self.starts, begin)  # word range of each text
        self.data, self.p = data, p

    def grams(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat buckets and their number per word of the words ``which``: n-grams of
        ``<word>`` for each length, and the whole word."""
        s, e = self.starts[which], self.ends[which]
        lens = e - s + 2
        flat = np.full(int(lens.sum()), 1, np.uint64)
        offs = np.cumsum(lens) - lens
        flat[offs + lens - 1] = 2
        inner = ragged(offs + 1, lens - 2)
        flat[inner] = self.data[ragged(s, lens - 2)]
        owner = np.repeat(np.arange(len(which)), lens)
        out, own = [], []
        room = np.repeat(offs + lens, lens) - np.arange(len(flat))  # symbols left in the word
        code = flat.copy()
        top = max(self.p.grams)
        for n in range(2, min(top, len(flat)) + 1):
            code[:len(flat) - n + 1] = code[:len(flat) - n + 1] * np.uint64(1099511628211) + flat[n - 1:]
            if n in self.p.grams:
                at = np.flatnonzero(room >= n)
                out.append(mix64(code[at] * np.uint64(16) + np.uint64(n)) % np.uint64(self.p.buckets))
                own.append(owner[at])
        step = np.arange(len(flat)) - np.repeat(offs, lens)
        powers = np.multiply.accumulate(np.concatenate(
            [[np.uint64(1)], np.full(int(lens.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64)]))
        whole = np.add.reduceat(flat * powers[step], offs) if len(which) else np.zeros(0, np.uint64)
        out.append(mix64(whole) % np.uint64(self.p.buckets))
        own.append(np.arange(len(which)))
        bucket, own = np.concatenate(out).astype(np.int32), np.concatenate(own)
        order = np.argsort(own, kind="stable")
        return bucket[order], np.bincount(own, minlength=len(which))


def numbered(text: bytes, p: Params) -> tuple[bytes, bytes]:
    """A text's distinct words, a line each, and its words as 32-bit numbers of these lines."""
    bag = Bag([text], p)
    _, at, word = np.unique(_word_hash(bag), return_index=True, return_inverse=True)
    words = [bag.data[a:b].tobytes() for a, b in zip(bag.starts[at].tolist(), bag.ends[at].tolist())]
    return b"\n".join(words), word.astype("<i4").tobytes()


def _word_hash(bag: Bag) -> np.ndarray:
    return RangeHash(bag.data)(bag.starts, bag.ends) if len(bag.starts) else np.zeros(0, np.uint64)


def _best_window(z: np.ndarray, first: np.ndarray, width: int, bias: float):
    """Per text the largest window mean plus bias (the bias alone without words), and the
    window's word range."""
    total = np.concatenate([[0.0], np.cumsum(z, dtype=np.float64)])
    n = np.diff(first)
    width_of = np.minimum(n, width)
    best = np.full(len(n), bias)
    lo = first[:-1].copy()
    some = np.flatnonzero(n)
    if len(some):
        owner = np.repeat(some, (n - width_of + 1)[some])
        at = ragged(first[:-1][some], (n - width_of + 1)[some])
        mean = (total[at + width_of[owner]] - total[at]) / width_of[owner]
        cut = np.concatenate([[0], np.cumsum((n - width_of + 1)[some])])
        top = np.maximum.reduceat(mean, cut[:-1])
        hit = mean == np.repeat(top, np.diff(cut))
        where = np.flatnonzero(hit)
        k = np.searchsorted(where, cut[:-1])  # the first best window of each text
        lo[some] = at[where[k]]
        best[some] = top + bias
    return best, lo, lo + width_of


@dataclass(frozen=True)
class Model:
    """``scalars[g]`` is the toxic-minus-clean logit of bucket g (embedding times the output
    layer's difference): all that scoring needs of the trained layers."""

    params: Params
    scalars: np.ndarray
    bias: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        bag = Bag(texts, self.params)
        if not len(bag.starts):
            return np.full(len(texts), self.bias)
        _, at, word = np.unique(_word_hash(bag), return_index=True, return_inverse=True)
        bucket, n = bag.grams(at)
        z = np.add.reduceat(self.scalars[bucket], np.cumsum(n) - n) / n
        return _best_window(z[word], bag.first, self.params.window, self.bias)[0]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        raw = [(t or "").encode() for t in texts]
        parts = [self.logits(raw[a:b]) for a, b in slices(map(len, raw), SLICE_BYTES)]
        z = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(texts: list[str], toxic: list[int], p: Params = Params()) -> Model:
    """Joint training of embeddings E and output U by Adagrad; the two-class softmax depends on
    u = U[1] - U[0] only."""
    return _fit([numbered(t.encode(), p) for t in texts], toxic, p)


def _fit(texts: list[tuple[bytes, bytes]], toxic: list[int], p: Params) -> Model:
    """``train`` on ``numbered`` texts."""
    y = np.array(toxic, float)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Model(p, np.zeros(p.buckets, np.float32), 30.0 if share else -30.0)
    bag = Bag([words for words, _ in texts], p)  # the distinct words of each text
    _, at, of = np.unique(_word_hash(bag), return_index=True, return_inverse=True)
    first = np.cumsum([0, *(len(spots) // 4 for _, spots in texts)])
    word = np.empty(int(first[-1]), np.int32)
    for k, (_, spots) in enumerate(texts):
        word[first[k]:first[k + 1]] = of[bag.first[k] + np.frombuffer(spots, "<i4")]
    bucket, n = bag.grams(at)
    offs = np.cumsum(n) - n
    word_of = np.repeat(np.arange(len(n)), n)
    rng = np.random.default_rng(p.seed)
    E = rng.normal(0, 0.05, (p.buckets, p.dim)).astype(np.float32)
    u = rng.normal(0, 0.5, p.dim).astype(np.float32)
    bias = float(np.log(share / (1 - share)))
    sum_e, sum_u, sum_b = np.full(E.shape, 1e-8, np.float32), np.full(p.dim, 1e-8), 1e-8
    for _ in range(p.epochs):
        g = E @ u
        z = np.add.reduceat(g[bucket], offs) / n if len(n) else np.zeros(0)
        logit, lo, hi = _best_window(z[word], first, p.window, bias)
        err = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y) / len(y)
        width = np.maximum(hi - lo, 1)
        at_words = ragged(lo, hi - lo)
        c_word = np.bincount(word[at_words], np.repeat(err / width, hi - lo), minlength=len(n))
        c = np.bincount(bucket, (c_word / n)[word_of], minlength=p.buckets)
        hot = np.flatnonzero(c)
        grad_e = c[hot, None] * u[None, :]
        grad_u = c[hot] @ E[hot] + p.decay * u
        sum_e[hot] += grad_e ** 2
        E[hot] -= p.rate * grad_e / np.sqrt(sum_e[hot])
        sum_u += grad_u ** 2
        u = (u - p.rate * 0.3 * grad_u / np.sqrt(sum_u)).astype(np.float32)
        sum_b += err.sum() ** 2
        bias -= p.rate * 0.3 * err.sum() / np.sqrt(sum_b)
        E *= 1 - p.decay
    return Model(p, (E @ u).astype(np.float32), bias)


def learn(docs: DataFrame, labels: DataFrame, held_mod: int = 4, held: int = 2,
          p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a bounded sample of the labelled rows outside fold ``held``."""
    marks = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
             .where(fold(id_col, held_mod) != held)
             .groupBy(F.col(id_col).alias("i")).agg(F.max("toxic").cast("int").alias("y"))
             .withColumn("h", F.xxhash64("i", F.lit(5))))
    picked = [marks.where(cond).orderBy("h", "i").limit(p.rows_per_class)
              for cond in ("y = 1", "y <> 1")]
    keys = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * rows_per_class rows
    rows = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
            .join(keys, "i"))
    sizes = rows.groupBy("y", "h", "i").agg(F.sum(F.length("t").cast("long")).alias("n")).collect()
    chosen, total = [], {}
    for r in sorted(sizes, key=lambda r: (r["h"], r["i"])):
        toxic = r["y"] == 1
        if toxic not in total or total[toxic] + r["n"] <= p.class_chars:
            chosen.append((r["h"],))
        total[toxic] = total.get(toxic, 0) + r["n"]  # the first row too many ends its class
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "h long").distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [numbered(t.encode(), p) for t in batch.pop("t")]
            yield batch.assign(words=[w for w, _ in found], spots=[x for _, x in found])

    kind = docs.schema[id_col].dataType.simpleString()
    got = (rows.join(wanted, "h").select("h", "i", "y", "t")
           .mapInPandas(run, f"h long, i {kind}, y int, words binary, spots binary").collect())
    got.sort(key=lambda r: (r["h"], r["i"], r["words"], r["spots"]))
    return _fit([(bytes(r["words"]), bytes(r["spots"])) for r in got], [int(r["y"] == 1) for r in got], p)


def score(docs: DataFrame, model: Model, threshold: float = TOXIC_FROM, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``score`` and ``predicted``, which replace columns of these
    names. No shuffle."""
    udf = _score(docs, model)
    return (docs.drop("score", "predicted").withColumn("score", udf(F.col(text_col)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows scored below ``threshold``, with the columns they came with."""
    return docs.where(_score(docs, model)(F.col(text_col)) < threshold)


def _score(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets * 4 bytes

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.scores(batch.tolist()))

    return F.pandas_udf(run, "double")


def classify(docs: DataFrame, labels: DataFrame, held_mod: int = 4, held: int = 2,
             threshold: float = TOXIC_FROM, id_col: str = "doc_id") -> DataFrame:
    model = learn(docs, labels, held_mod, held, id_col=id_col)
    out = docs.select(F.col(id_col), F.col("text"), (fold(id_col, held_mod) == held).alias("held_out"))
    return score(out, model, threshold).drop("text")

"""Language ID by compression: a text belongs to the language whose zstandard raw-content
dictionary compresses it smallest.

Learning reads a bounded sample: for every language up to ``docs_per_lang`` rows in the order of
their key hash, texts of more than ``long_chars`` characters last, whole texts as long as they
stay within ``sample_chars`` together (the first one in any case); they are joined up to
``dict_bytes``. Prediction reads every whole text, in pieces of ``PIECE`` bytes, so that long
texts keep using the dictionary and not their own past.

A text is accepted if the runner-up is larger by more than ``reject_margin`` and the text takes no
more bytes per letter than ``HELD_SHARE`` of its language's held-out sample rows cut to the same
number of letters: random letters and unlearned languages fit no dictionary. Held out is every
second sampled row, against a dictionary of the others. The quantile of n rows is widened by the
share ``HELD_SLACK`` / n, so few rows bind loosely and none not at all, by one rule at every size.

Defined cases: NULL text or text without letters is ``und`` with score 0; ties go to the
language with more learning rows, then by name; with nothing learned every text is ``und``;
repeated rows get equal answers; a NULL key learns and predicts like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.common import fold

UNKNOWN = "und"
PIECE = 4096
_HASHES = 1 << 40
LEVEL = 5
FRAME = 9           # bytes of a compressed piece besides its content
REJECT_MARGIN = 0.02
HELD_SHARE = 0.995
HELD_SLACK = 2.0
CUTS = (16, 32, 64, 128, 256, 600)  # characters at which the held-out rows are measured
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower case, and one blank for everything between letters: what dictionaries hold and
    texts are compressed as."""
    return _NOT_LETTERS.sub(" ", text.lower())


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order of frequency, with their dictionaries."""

    langs: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    # per language the (letters, bytes per letter) of its bound; empty without held-out rows
    bounds: tuple[tuple[tuple[float, float], ...], ...] = ()

    def bound(self, lang: int, n_letters: int) -> float:
        points = self.bounds[lang] if self.bounds else ()
        if not points:
            return np.inf
        at, most = zip(*points)
        return float(np.interp(np.log(n_letters), np.log(at), most))


def _n_letters(text: str) -> int:
    return len(letters(text).replace(" ", ""))


def _bytes_per_letter(size: int, raw_bytes: int, n_letters: int) -> float:
    return (size - FRAME * -(-raw_bytes // PIECE)) / n_letters


def _bound(parts: list[str], dict_bytes: int) -> tuple[tuple[float, float], ...]:
    """The bytes per letter that the share HELD_SHARE of held-out parts stays within, by length."""
    held, book = parts[1::2], "\n".join(map(letters, parts[::2])).encode()[:dict_bytes]
    tool = Classifier(LanguageModel(("",), (book,)))
    out = []
    for cut in CUTS:
        rows = []
        for text in {x[:cut] for x in held if len(x) >= cut}:
            n = _n_letters(text)
            if n:
                raw = len(letters(text).encode())
                rows.append((n, _bytes_per_letter(int(tool.sizes(text)[0]), raw, n)))
        if rows:
            n, rate = np.array(rows).T
            out.append((float(np.median(n)), float(np.quantile(rate, HELD_SHARE)) * (1 + HELD_SLACK / len(rows))))
    return tuple(sorted(dict(out).items()))


def learn(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 400,
          sample_chars: int = 1_000_000, long_chars: int = 20_000, dict_bytes: int = 110_000) -> LanguageModel:
    """Learn from rows with non-NULL text and language for which ``usable`` holds. The model has a
    dictionary per language, so its size is bounded by the languages."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("g"),
                       (F.lit(True) if usable is None else usable).alias("ok"))
    rows = rows.where("ok and g is not null and t is not null")
    long = F.length("t") > long_chars
    counted = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_if(~long).alias("usual")).collect()
    sizes = {r["g"]: r["n"] for r in sorted(counted, key=lambda r: (-r["n"], r["g"]))}
    if not sizes:
        return LanguageModel((), ())
    langs = list(sizes)
    # the hash thins a language to about four times the wanted rows before any row is moved; long
    # texts take part where the others are fewer than wanted
    place = F.pmod(F.xxhash64("i", F.lit(11)), F.lit(_HASHES))
    picked = [(r["g"], r["usual"] < docs_per_lang, r["n"] if r["usual"] < docs_per_lang else r["usual"]) for r in counted]
    reach = F.create_map(*[F.lit(x) for g, _, n in picked
                           for x in (g, min(_HASHES, 4 * docs_per_lang * _HASHES // n))])
    with_long = F.array(*[F.lit(g) for g, every, _ in picked if every]).cast("array<string>")
    thin = rows.where((place < reach[F.col("g")]) & (~long | F.array_contains(with_long, F.col("g"))))
    first = Window.partitionBy("g").orderBy("long", "h")
    keys = (thin.groupBy("g", place.alias("h")).agg(F.min(long).alias("long"), F.max(F.length("t")).alias("c"))
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= docs_per_lang)
            .withColumn("upto", F.sum("c").over(first.rowsBetween(Window.unboundedPreceding, 0)))
            .where((F.col("upto") <= sample_chars) | (F.col("n") == 1)).select("g", "h", "n"))
    parts = (rows.withColumn("h", place)
             .join(F.broadcast(keys), ["g", "h"])  # docs_per_lang rows of a language at most
             .groupBy("g", "h", "n").agg(F.min("t").alias("p"))
             .select("g", F.col("n").alias("h"), "p").collect())
    texts: dict[str, list[tuple[int, str]]] = {g: [] for g in langs}
    for r in parts:
        texts[r["g"]].append((r["h"], r["p"]))
    books, bounds = [], []
    for g in langs:
        seen = dict.fromkeys(p for _, p in sorted(texts[g]))
        books.append("\n".join(map(letters, seen)).encode()[:dict_bytes])
        bounds.append(_bound(list(seen), dict_bytes))
    return LanguageModel(tuple(langs), tuple(books), tuple(bounds))


class Classifier:
    def __init__(self, model: LanguageModel):
        self.model, self.langs = model, model.langs
        self.tools = []
        for book in model.dictionaries:
            if len(book) >= 8:
                d = zstandard.ZstdCompressionDict(book, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self.tools.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False))
            else:
                self.tools.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))

    def sizes(self, text: str) -> np.ndarray:
        return self._sizes(letters(text).encode())

    def _sizes(self, raw: bytes) -> np.ndarray:
        pieces = [raw] if len(raw) <= PIECE else [raw[a:a + PIECE] for a in range(0, len(raw), PIECE)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.tools])

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score in [0, 1], margin (the runner-up's size over the best's, minus 1) and
        whether its bytes per letter stay within the language's bound."""
        if not text or not self.tools or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, False
        plain = letters(text)
        raw = plain.encode()
        size = self._sizes(raw)
        best = int(size.argmin())
        n = max(len(plain) - plain.count(" "), 1)
        fits = _bytes_per_letter(int(size[best]), len(raw), n) <= self.model.bound(best, n)
        if len(size) == 1:
            return self.langs[0], 1.0, 1.0, fits
        margin = float(np.partition(size, 1)[1] / size[best] - 1)
        # soft maximum over relative sizes: a hundredth of the size is worth a factor of e
        score = float(1 / np.exp(-100.0 * (size / size[best] - 1)).sum())
        return self.langs[best], score, margin, fits


def predict(docs: DataFrame, model: LanguageModel, reject_margin: float = REJECT_MARGIN,
            text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score, margin and ``accepted``, which replace
    columns of these names. Rejected is what has no language, a margin of
    ``reject_margin`` or less, or more bytes per letter than its language's bound. No shuffle."""
    names = ("lang_pred", "score", "margin", "accepted")
    guess = _guess(model, reject_margin)
    out = docs.drop(*names, "_guess").withColumn("_guess", guess(F.col(text_col)))
    return out.select("*", *[F.col(f"_guess.{x}") for x in names]).drop("_guess")


def keep(docs: DataFrame, model: LanguageModel, reject_margin: float = REJECT_MARGIN,
         text_col: str = "text") -> DataFrame:
    """The rows that ``predict`` accepts, with the columns they came with. Where no language was
    learned, nothing can be told apart and all rows stay."""
    if not model.langs:
        return docs
    guess = _guess(model, reject_margin)
    return docs.where(guess(F.col(text_col))["accepted"])


def _guess(model: LanguageModel, reject_margin: float):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = Classifier(model)
        for batch in batches:
            got = [tool(t) for t in batch]
            out = pd.DataFrame(got, columns=["lang_pred", "score", "margin", "fits"])
            sure = (out["margin"] > reject_margin) & out["fits"].astype(bool)
            yield out.assign(accepted=(out["lang_pred"] != UNKNOWN) & sure).drop(columns="fits")

    return F.pandas_udf(run, "lang_pred string, score double, margin double, accepted boolean")


def identify(docs: DataFrame, held_mod: int = 5, id_col: str = "doc_id") -> DataFrame:
    """Learn from the rows outside fold 0 of ``held_mod``, predict every row."""
    held = fold(id_col, held_mod) == 0
    model = learn(docs, usable=~held, id_col=id_col)
    return predict(docs.select(F.col(id_col), F.col("text"), held.alias("held_out")), model).drop("text")

"""Fill-in-the-middle transformation by word-parallel select over the UTF-8 bytes.

A unit is a run of white space followed by a run of other characters; white space at the end of
a text is a unit of its own. White space is ASCII, so units are runs of bytes, and the bytes of
many texts are viewed as 64-bit words: each text starts at a word and is padded with spaces.
Additions that cannot carry from one byte to the next mark in every word the bytes that end a
unit, ``bitwise_count`` gives the units of a word, and a running sum over the words those before
it. A cut after unit k is the k-th mark: the running sums are searched for its word, the lower
marks of that word are cleared, and the place of the lowest one left is its byte. Code points
are counted the same way, from the bytes that do not continue a character.

Cuts are drawn from the row's id alone (sha256 of ``seed:id``), so a row gives the same result in
any run. ``restore`` rebuilds the text from output and form.

Defined cases: a NULL text counts as empty, and an empty one stays plain with no units; a text
that holds a marker stays plain; a NULL id draws as an id of empty text; repeated rows are
transformed alike, one by one; a text of white space alone has one unit; an empty table gives no
rows; columns of the input beside id and text are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import slices

MARKERS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
SLICE_BYTES = 8 << 20  # texts taken together; a longer text is a slice of its own


@dataclass(frozen=True)
class Params:
    seed: int = 42
    fim_percent: int = 50  # of the texts
    spm_percent: int = 80  # of the texts transformed


def _every(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW, _ONE = _every(0x80), _every(0x7F), np.uint64(1)


def _spaces(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a space or lies in 0x09 to 0x0D."""
    y = words & _LOW
    after = y + _every(0x80 - 0x09)  # sums of two 7-bit values stay inside their byte
    past = y + _every(0x80 - 0x0E)
    other = (y ^ _every(0x20)) + _LOW
    return ((after & ~past) | ~other) & ~words & _HIGH


def _place(marks: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The byte of the ``nth`` (from 1) mark in each word."""
    marks = marks.copy()
    for k in range(1, 8):
        more = nth > k
        if not more.any():
            break
        marks[more] &= marks[more] - _ONE
    lowest = marks & (~marks + _ONE)
    return np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3


class Units:
    """The units and characters of several texts in UTF-8."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.first = np.zeros(len(texts) + 1, np.int64)  # every text's first word
        np.cumsum(lengths // 8 + 1, out=self.first[1:])  # one byte of padding at least
        words = np.frombuffer(b"".join([t + b" " * (8 - len(t) % 8) for t in texts]), "<u8")
        space = _spaces(words)
        following = space >> np.uint64(8)
        following[:-1] |= space[1:] << np.uint64(56)
        following[-1:] |= np.uint64(1 << 63)
        marks = ~space & following & _HIGH
        # White space at the end of a text: its last byte ends a unit.
        some = np.flatnonzero(lengths)
        last = self.first[some] * 8 + lengths[some] - 1
        bit = np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64)
        marks[last >> 3] |= bit & space[last >> 3]
        self.marks = marks
        self.before = self._running(marks)
        self.chars = ~(words & ~(words << _ONE)) & _HIGH  # bytes that are not 10xxxxxx
        self.chars_before = self._running(self.chars)
        self.n = self.before[self.first[1:]] - self.before[self.first[:-1]]

    @staticmethod
    def _running(marks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=out[1:])
        return out

    def ends(self, texts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """The byte of ``texts`` behind their first ``units`` units."""
        out = np.zeros(len(texts), np.int64)
        some = np.flatnonzero(units)
        at = self.first[texts[some]]
        rank = self.before[at] + units[some]
        word = np.searchsorted(self.before, rank, "left") - 1
        out[some] = (word - at) * 8 + _place(self.marks[word], rank - self.before[word]) + 1
        return out

    def chars_to(self, texts: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The code points in the first ``stop`` bytes of ``texts``."""
        at = self.first[texts]
        word = at + (stop >> 3)
        below = (_ONE << ((stop & 7) * 8).astype(np.uint64)) - _ONE
        return (self.chars_before[word] - self.chars_before[at]
                + np.bitwise_count(self.chars[word] & below).astype(np.int64))


def draws(ids: list, seed: int) -> np.ndarray:
    """Four 32-bit draws for every id: the first groups of the hex sha256 of ``seed:id``."""
    blob = b"".join(sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(blob, ">u4").reshape(-1, 4).astype(np.int64)


def _rows(ids: list, texts: list[bytes], p: Params) -> dict[str, list]:
    units = Units(texts)
    h = draws(ids, p.seed)
    every = np.arange(len(ids))
    cuts = np.sort(h[:, :2] % (units.n + 1)[:, None], axis=1)
    first, second = units.ends(every, cuts[:, 0]), units.ends(every, cuts[:, 1])
    prefix = units.chars_to(every, first)
    middle = units.chars_to(every, second) - prefix
    fim, spm = h[:, 2] % 100 < p.fim_percent, h[:, 3] % 100 < p.spm_percent
    pre, suf, mid = (m.encode() for m in MARKERS)
    out: dict[str, list] = {"n": units.n.tolist(), "form": [], "prefix_chars": [], "middle_chars": [],
                            "output": []}
    for i, text in enumerate(texts):
        if fim[i] and text and not (pre in text or suf in text or mid in text):
            a, b = int(first[i]), int(second[i])
            sizes = int(prefix[i]), int(middle[i])
            if spm[i]:
                form, made = "spm", b"".join((suf, text[b:], pre, text[:a], mid, text[a:b]))
            else:
                form, made = "psm", b"".join((pre, text[:a], suf, text[b:], mid, text[a:b]))
        else:
            form, made, sizes = "plain", text, (None, None)
        for name, value in zip(("form", "prefix_chars", "middle_chars", "output"), (form, *sizes, made)):
            out[name].append(value)
    return out


def transform(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Per row: id, n (units), form, prefix_chars, middle_chars (NULL where plain), output."""
    ident = docs.schema[id_col].dataType.simpleString()
    out_type = f"i {ident}, n long, form string, prefix_chars long, middle_chars long, output string"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["b"].to_pylist(), SLICE_BYTES):
                part = batch.slice(a, b - a)
                cols = _rows(part["i"].to_pylist(), part["t"].cast(pa.binary()).to_pylist(), p)
                arrays = [pa.array(v, k) for v, k in zip(cols.values(), kinds)]
                arrays[-1] = arrays[-1].cast(pa.string())  # bytes cut between characters
                yield pa.RecordBatch.from_arrays([part["i"], *arrays], ["i", *cols])

    plain = F.coalesce(F.col(text_col), F.lit(""))
    out = (docs.select(F.col(id_col).alias("i"), plain.alias("t"), F.octet_length(plain).alias("b"))
           .mapInArrow(run, out_type))
    return out.withColumnRenamed("i", id_col)


def restore(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text from which ``transform`` made ``output``; a marker occurs in it once at most."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    part = F.split(output, "|".join(MARKERS), -1)
    return (F.when(form == "spm", F.concat(part[2], part[3], part[1]))
            .when(form == "psm", F.concat(part[1], part[3], part[2]))
            .otherwise(output))

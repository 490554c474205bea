"""Byte-level BPE by rank-synchronous merging of ragged numpy arrays.

Texts are cut into pre-tokens by vectorised character classes, equal pre-tokens of a slice are
encoded once, and all sequences merge together: in each round every sequence applies all
occurrences of its own lowest-rank pair; a sequence without a ranked pair leaves the batch.
Pairs made by a merge always rank after it, so this equals merging one pair at a time.

Defined cases: NULL and empty text have no tokens; the special token's string inside a text is
one token (the library's default); texts of any length are cut only where a pre-token must
start, and a single pre-token above ``LONG`` bytes is merged with a heap in O(n log n).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import RangeHash, ragged

SLICE_CHARS = 1 << 21  # characters encoded together
LONG = 2048            # bytes of a pre-token beyond which the heap is used
_NONE = np.int32(np.iinfo(np.int32).max)

# The pre-tokenizer's white space (Unicode White_Space) and contractions.
_WHITE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
          (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
_CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
_S, _L, _N, _O = range(4)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    out = np.full(0x110000, _O, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_L, r"\p{L}+"), (_N, r"\p{N}+")):
        for m in regex.finditer(pattern, points):
            shift = [0x800 * (i >= 0xD800) for i in (m.start(), m.end() - 1)]
            out[m.start() + shift[0]:m.end() + shift[1]] = kind
    out[0xD800:0xE000] = _O
    for a, b in _WHITE:
        out[a:b + 1] = _S
    return out


def pre_tokens(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Start positions of the pre-tokens of concatenated texts. ``cp``: code points;
    ``first``: True where a text starts."""
    n = len(cp)
    cls = _classes()[cp]
    starts = first.copy()
    starts[1:] |= cls[1:] != cls[:-1]
    # the last white-space character before other text stands alone or, if a blank, joins it
    after = np.flatnonzero(starts[1:] & ~first[1:] & (cls[1:] != _S) & (cls[:-1] == _S)) + 1
    starts[after - 1] = True
    starts[after[cp[after - 1] == 0x20]] = False
    quotes = np.flatnonzero((cp == 0x27) & starts)
    for word in _CONTRACTIONS:
        p = quotes[quotes + len(word) < n]
        for k, ch in enumerate(word, 1):
            p = p[(cp[p + k] == ord(ch)) & ~first[p + k]]
        if len(p):
            starts[p + 1] = False
            end = p + len(word) + 1
            starts[end[end < n]] = True
    return np.flatnonzero(starts)


class BytePairEncoder:
    """Vocabulary and merge ranks of a byte-level BPE ``.json`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        # each byte's visible stand-in character: itself if printable, else the next free one
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        chars = {b: chr(b) for b in plain}
        for k, b in enumerate(x for x in range(256) if x not in chars):
            chars[b] = chr(256 + k)
        self.byte_ids = np.array([vocab[chars[b]] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.uint64)
        right = np.array([vocab[b] for _, b in pairs], np.uint64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._build(left << np.uint64(32) | right)

    def _build(self, keys: np.ndarray) -> None:
        """Open-addressing table from pair to rank, four slots per key."""
        self._shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self._shift))
        self._keys = np.full(size + 64, np.uint64(2**64 - 1))
        self._ranks = np.full(size + 64, _NONE)
        rank, key, slot = np.arange(len(keys), dtype=np.int32), keys, self._slot(keys)
        self._probes = 0
        while len(key):
            self._probes += 1
            free = self._keys[slot] == np.uint64(2**64 - 1)
            _, at = np.unique(np.where(free, slot, -1), return_index=True)
            at = at[free[at]]
            self._keys[slot[at]], self._ranks[slot[at]] = key[at], rank[at]
            rest = np.ones(len(key), bool)
            rest[at] = False
            key, rank, slot = key[rest], rank[rest], slot[rest] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        seen = self._keys[slot]
        out = np.where(seen == keys, self._ranks[slot], _NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != np.uint64(2**64 - 1)))
        for step in range(1, self._probes + 1):
            if not len(open_):
                break
            seen = self._keys[slot[open_] + step]
            same = seen == keys[open_]
            out[open_[same]] = self._ranks[slot[open_[same]] + step]
            open_ = open_[~same & (seen != np.uint64(2**64 - 1))]
        return out

    def merge(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of ragged byte-symbol sequences (each at least one symbol)."""
        seq = np.arange(len(lens))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        big = np.flatnonzero(lens > LONG)
        if len(big):
            offs = np.cumsum(lens) - lens
            for k in big:
                ids = self._heap(sym[offs[k]:offs[k] + lens[k]])
                done.append((np.array([k]), np.array([len(ids)]), ids))
            keep = lens <= LONG
            sym, seq, lens = sym[np.repeat(keep, lens)], seq[keep], lens[keep]
        while len(seq):
            ends = np.cumsum(lens)
            rank = np.full(len(sym), _NONE)
            rank[:-1] = self._rank(sym[:-1], sym[1:])
            rank[ends - 1] = _NONE
            low = np.minimum.reduceat(rank, ends - lens)
            live = low != _NONE
            if not live.all():
                keep = np.repeat(live, lens)
                done.append((seq[~live], lens[~live], sym[~keep]))
                sym, rank, seq, lens, low = sym[keep], rank[keep], seq[live], lens[live], low[live]
                if not len(seq):
                    break
            owner = np.repeat(np.arange(len(seq)), lens)
            hit = rank == low[owner]
            run = np.flatnonzero(hit[1:] & hit[:-1])
            if len(run):  # equal symbols in a row: take every other pair, from the left
                at = np.arange(len(hit))
                last = np.maximum.accumulate(np.where(hit, -1, at))
                hit &= (at - last) % 2 == 1
            at = np.flatnonzero(hit)
            sym[at] = self.merged[low[owner[at]]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            lens = lens - np.bincount(owner[at], minlength=len(seq))
            sym = sym[keep]
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        order, lens, sym = (np.concatenate(x) for x in zip(*done))
        out = np.empty(len(order), np.int64)
        out[order] = lens
        target = np.empty(len(sym), np.int32)
        target[ragged((np.cumsum(out) - out)[order], lens)] = sym
        return target, out

    def _heap(self, sym: np.ndarray) -> np.ndarray:
        """One long sequence: pairs in a heap by (rank, position), neighbours linked."""
        ids = sym.tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self._rank(sym[:-1], sym[1:])
        heap = [(int(ranks[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(ranks != _NONE)]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int) -> None:
            pair = (ids[i], ids[nxt[i]])
            if pair not in known:
                known[pair] = int(self._rank(np.array([pair[0]]), np.array([pair[1]]))[0])
            if known[pair] != _NONE:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if ids[i] != a or nxt[i] >= n or ids[nxt[i]] != b:
                continue
            j = nxt[i]
            ids[i], ids[j] = int(self.merged[rank]), -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                push(i)
            if prv[i] >= 0:
                push(prv[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def _parts(self, text: str) -> Iterator[str | int]:
        """A text's special tokens (ids) and the ordinary pieces between them, cut where a
        pre-token must start once a piece is longer than a slice."""
        pieces: list[str | int] = [text]
        for content, ident in self.special.items():
            if content in text:
                pieces = [y for x in pieces for y in (
                    [x] if isinstance(x, int) else
                    [z for part in x.split(content) for z in (part, ident)][:-1])]
        for x in pieces:
            if isinstance(x, str) and len(x) > SLICE_CHARS:
                at = 0
                for m in regex.finditer(r"(?<=\S) (?=\S)", x, pos=SLICE_CHARS):
                    if m.start() - at >= SLICE_CHARS:
                        yield x[at:m.start()]
                        at = m.start()
                yield x[at:]
            elif x != "":
                yield x

    def encode_flat(self, texts: list[str | None], ids: bool = True):
        """Per text its token count and, with ``ids``, all ids in one flat array."""
        parts: list[str | int] = []
        owner: list[int] = []
        for k, text in enumerate(texts):
            for p in self._parts(text) if text else ():
                parts.append(p)
                owner.append(k)
        counts = np.zeros(len(texts), np.int64)
        flat: list[np.ndarray] = []
        at = 0
        while at < len(parts):
            end, chars = at, 0
            while end < len(parts) and (end == at or chars < SLICE_CHARS):
                chars += len(parts[end]) if isinstance(parts[end], str) else 1
                end += 1
            n, got = self._slice(parts[at:end], ids)
            np.add.at(counts, owner[at:end], n)
            flat.append(got)
            at = end
        if not ids:
            return counts, None
        return counts, np.concatenate(flat) if flat else np.zeros(0, np.int32)

    def _slice(self, parts: list[str | int], ids: bool):
        words = [x for x in parts if isinstance(x, str)]
        is_word = np.array([isinstance(x, str) for x in parts])
        n = np.ones(len(parts), np.int64)
        if not words:
            return n, np.array(parts, np.int32) if ids else None
        cp = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.zeros(len(cp), bool)
        first[np.cumsum(size) - size] = True
        starts = pre_tokens(cp, first)
        ends = np.append(starts[1:], len(cp))
        _, at, token = np.unique(RangeHash(cp)(starts, ends), return_index=True, return_inverse=True)
        lens = ends[at] - starts[at]
        kinds = cp[ragged(starts[at], lens)]
        width = 1 + (kinds > 0x7F) + (kinds > 0x7FF) + (kinds > 0xFFFF)
        raw = np.frombuffer(kinds.tobytes().decode("utf-32-le").encode(), np.uint8)
        n_bytes = np.add.reduceat(width, np.cumsum(lens) - lens)
        sym, n_ids = self.merge(self.byte_ids[raw], n_bytes)
        per_token = n_ids[token]
        n[is_word] = np.add.reduceat(per_token, np.searchsorted(starts, np.cumsum(size) - size))
        if not ids:
            return n, None
        offsets = np.cumsum(n_ids) - n_ids
        flat = sym[ragged(offsets[token], per_token)]
        if is_word.all():
            return n, flat
        out = np.empty(int(n.sum()), np.int32)
        where = np.repeat(is_word, n)
        out[where] = flat
        out[~where] = [x for x in parts if isinstance(x, int)]
        return n, out


@lru_cache(4)
def encoder(path: str) -> BytePairEncoder:
    return BytePairEncoder(path)


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens and whether the tokens exceed ``limit``. NULL text
    counts as empty; rows are independent, so there is no shuffle and repeats stay repeats."""
    ident = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:  # ids stay Arrow: pandas would turn longs beside a NULL into doubles
            counts, _ = bpe.encode_flat(batch["t"].to_pylist(), ids=False)
            counts = np.asarray(counts, np.int64)
            yield pa.RecordBatch.from_arrays([batch["i"], batch["b"], pa.array(counts), pa.array(counts > limit)],
                                             ["i", "n_bytes", "n_tokens", "over_limit"])

    out = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("b"))
           .mapInArrow(run, f"i {ident}, n_bytes long, n_tokens long, over_limit boolean"))
    return out.withColumnRenamed("i", id_col)

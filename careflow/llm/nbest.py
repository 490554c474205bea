"""N-best segmentation with SentencePiece vocabularies.

The piece lattice of a text falls apart at places that no piece can cross (before a word mark,
around characters without longer pieces). Per distinct segment a vectorised forward Viterbi
pass gives the best score of every prefix, and a backward pass every edge's best whole path, so
the loss of the best alternative is known without a search. A text's n best segmentations can
only differ in the n - 1 segments with the smallest losses: there, A* searches the lattice
backward from the end, with the forward scores as exact heuristic, so that each completed path
is the next best. The text's list merges the segments' lists.

Rank 1 is the library's own encoding, which for a BPE model follows the order of the merges: no
sum of piece scores gives it (they are minus the merge rank, and the largest sum takes more and
shorter pieces). The library encodes each distinct segment; as no piece crosses a cut, no merge
does. Ranks 2 to n are the other segmentations with the largest sums, so rank 1 can have a
smaller score than they.

Prose repeats its words, so solved segments are kept from slice to slice, up to ``STORE_BYTES``:
their best ids, scores, losses, the library's ids, and whether these spell the segment.

Scores are sums of the model's piece scores; a character without a piece costs the least piece
score less ten and is spelled in byte pieces if the model has them, else as the unknown id.

Defined cases: NULL and empty text has one segmentation without pieces and score 0; texts with
fewer than n segmentations get fewer rows; ties go to fewer pieces, then the smaller ids;
repeated rows are repeated.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from careflow.llm.common import RangeHash, ragged, slices

SLICE_CHARS = 1 << 21
STORE_BYTES = 48 << 20  # of solved segments kept for later slices
SHORT = 40          # segments up to this length share the array passes
_TOP = np.uint64(46)  # the hash bits that index the 2**18 flags of a table
MARK = "▁"     # fixed value: the word mark


class PieceLattice:
    def __init__(self, path: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        names = [sp.id_to_piece(i) for i in range(size)]
        self.unknown = sp.unk_id()
        self.bytes = {int(names[i][3:-1], 16): i for i in range(size) if sp.is_byte(i)}
        ids = [i for i in range(size) if not special[i] and names[i]]
        self.score = np.array([sp.get_score(i) for i in range(size)])
        self.no_piece = float(self.score[ids].min()) - 10.0
        self.by_text = {names[i]: i for i in ids}
        self.longest = max(map(len, self.by_text))
        inner = [p for p in self.by_text if len(p) > 1]
        self.cut_marks = not any(MARK in p.lstrip(MARK) for p in inner)
        self.joined = np.zeros(0x110000, bool)  # characters of pieces with several characters
        self.joined[[ord(c) for c in set("".join(inner))]] = True
        self.tables = {}
        for n in range(1, self.longest + 1):
            own = [p for p in self.by_text if len(p) == n]
            if own:
                cp = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
                at = np.arange(len(own)) * n
                h = RangeHash(cp)(at, at + n)
                order = np.argsort(h)
                maybe = np.zeros(1 << 18, bool)  # most places have no piece: one look rules them out
                maybe[h >> _TOP] = True
                self.tables[n] = maybe, h[order], np.array([self.by_text[p] for p in own])[order]
        # what each id decodes to
        raw = [bytes([int(names[i][3:-1], 16)]) if sp.is_byte(i) else
               b"" if special[i] else names[i].replace(MARK, " ").encode() for i in range(size)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.fromiter(map(len, raw), np.int64, size)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.covers = np.array([0 if x else len(name) for x, name in zip(special, names)])  # characters
        # the library without its normaliser, for segments of texts that have passed it
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        spec = proto.normalizer_spec
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def normalize(self, text: str | None) -> str:
        return self.sp.normalize(text) if text else ""

    def decode(self, ids: np.ndarray) -> str:
        """The normalised text of ids, with word marks as blanks."""
        return self.raw[ragged(self.raw_at[ids], self.raw_len[ids])].tobytes().decode("utf-8", "replace")

    def spelled(self, ch: str) -> list[int]:
        if self.bytes:
            return [self.bytes[b] for b in ch.encode()]
        return [self.unknown]

    def runs(self, ids: np.ndarray) -> np.ndarray:
        """The library writes neighbouring characters without a piece as one unknown id."""
        again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        return ids[np.append(True, ~again)] if again.any() else ids

    def cuts(self, cp: np.ndarray, first: np.ndarray) -> np.ndarray:
        start = first.copy()
        alone = ~self.joined[cp]
        start |= alone
        start[1:] |= alone[:-1]
        if self.cut_marks:
            mark = cp == ord(MARK)
            start[1:] |= mark[1:] & ~mark[:-1]
        return np.flatnonzero(start)

    def edges(self, cp: np.ndarray, room: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per piece length and position, the id (-1: none) and score of the piece there."""
        hash_of = RangeHash(cp)
        out = {}
        for n, (maybe, keys, ids) in self.tables.items():
            ident = np.full(len(cp), -1, np.int64)
            at = np.flatnonzero(room >= n)
            if len(at):
                h = hash_of(at, at + n)
                some = maybe[h >> _TOP]
                at, h = at[some], h[some]
                slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[slot] == h
                ident[at[hit]] = ids[slot[hit]]
            out[n] = ident, np.where(ident >= 0, self.score[ident], -np.inf)
        ident, score = out.setdefault(1, (np.full(len(cp), -1, np.int64), np.full(len(cp), -np.inf)))
        score[ident < 0] = self.no_piece
        return out


class Segments:
    """Distinct segments (given by start and length in ``cp``), solved together."""

    def __init__(self, lattice: PieceLattice, cp: np.ndarray, lens: np.ndarray):
        self.lattice, self.cp, self.lens = lattice, cp, lens
        self.at = np.cumsum(lens) - lens
        n = len(lens)
        room = np.repeat(self.at + lens, lens) - np.arange(len(cp))
        self.edge = lattice.edges(cp, room)
        self.alpha: list[np.ndarray | None] = [None] * n
        self.loss = np.full(n, np.inf)
        self.best = np.zeros(n)
        self.found: dict[int, list] = {}
        chunks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        short = np.flatnonzero(lens <= SHORT)
        short = short[np.argsort(-lens[short], kind="stable")]
        if len(short):
            chunks.append(self._together(short))
        for k in np.flatnonzero(lens > SHORT).tolist():
            chunks.append(self._alone(k))
        order, count, flat = (np.concatenate(x) for x in zip(*chunks))
        self.n_ids = np.empty(n, np.int64)
        self.n_ids[order] = count
        self.id_at = np.cumsum(self.n_ids) - self.n_ids
        self.ids = np.empty(len(flat), np.int64)
        self.ids[ragged(self.id_at[order], count)] = flat

    def library(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The library's ids of the segments: their number, place and sequence, and the scores."""
        tool = self.lattice
        text = self.cp.tobytes().decode("utf-32-le")
        found = tool.plain.encode([text[a:a + n] for a, n in zip(self.at.tolist(), self.lens.tolist())], num_threads=1)
        count = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((x for part in found for x in part), np.int64, int(count.sum()))
        at = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(count)), count)
        known = tool.covers[ids] > 0
        total = np.bincount(owner, np.where(known, tool.score[ids], 0.0), len(count))
        lost = self.lens - np.bincount(owner, tool.covers[ids], len(count))
        return count, at, ids, total + lost * tool.no_piece

    def _spell(self, ids: np.ndarray, at: np.ndarray, owner: np.ndarray):
        """Replace missing pieces (id -1 at position ``at``) by their spelling."""
        if (ids >= 0).all():
            return ids, owner
        lost = np.flatnonzero(ids < 0)
        size = np.ones(len(ids), np.int64)
        spelled = [self.lattice.spelled(chr(c)) for c in self.cp[at[lost]].tolist()]
        size[lost] = [len(x) for x in spelled]
        out = np.repeat(ids, size)
        out[np.repeat(ids < 0, size)] = [x for part in spelled for x in part]
        return out, np.repeat(owner, size)

    def _together(self, which: np.ndarray):
        """Forward and backward passes over segments sorted by decreasing length."""
        lens, at = self.lens[which], self.at[which]
        top = int(lens[0])
        alpha = np.full((top + 1, len(which)), -np.inf)
        back = np.zeros((top + 1, len(which)), np.int64)
        alpha[0] = 0
        alive = np.searchsorted(-lens, -np.arange(top + 1), side="right")  # segments of length >= j
        for j in range(1, top + 1):
            m = alive[j]
            for n, (_, score) in self.edge.items():
                if n <= j:
                    through = alpha[j - n, :m] + score[at[:m] + j - n]
                    better = through > alpha[j, :m]
                    alpha[j, :m][better] = through[better]
                    back[j, :m][better] = n
        beta = np.full((top + 1, len(which)), -np.inf)
        beta[lens, np.arange(len(which))] = 0
        for j in range(top - 1, -1, -1):
            for n, (_, score) in self.edge.items():
                if j + n <= top and (m := alive[j + n]):
                    np.maximum(beta[j, :m], beta[j + n, :m] + score[at[:m] + j], out=beta[j, :m])
        best = alpha[lens, np.arange(len(which))]
        # the best path, from the end
        on_path = np.zeros((top + 1, len(which)), np.int64)
        pos = lens.copy()
        owner, place, length = [], [], []
        while len(open_ := np.flatnonzero(pos)):
            n = back[pos[open_], open_]
            pos[open_] -= n
            on_path[pos[open_], open_] = n
            owner.append(open_)
            place.append(pos[open_].copy())
            length.append(n)
        owner, place, length = np.concatenate(owner), np.concatenate(place), np.concatenate(length)
        loss = np.full(len(which), np.inf)
        for j in range(top):
            for n, (_, score) in self.edge.items():
                if j + n <= top and (m := alive[j + n]):
                    lost = best[:m] - (alpha[j, :m] + score[at[:m] + j] + beta[j + n, :m])
                    lost[on_path[j, :m] == n] = np.inf
                    np.minimum(loss[:m], lost, out=loss[:m])
        self.loss[which], self.best[which] = loss, best
        self._column = dict(zip(which.tolist(), range(len(which))))
        self._alpha = alpha
        order = np.lexsort((place, owner))
        owner, place, length = owner[order], place[order], length[order]
        spot = at[owner] + place
        ids = np.empty(len(owner), np.int64)
        for n in np.unique(length).tolist():
            sel = length == n
            ids[sel] = self.edge[n][0][spot[sel]]
        ids, owner = self._spell(ids, spot, owner)
        return which, np.bincount(owner, minlength=len(which)), ids

    def _alone(self, k: int):
        """One long segment: the forward pass in a loop, two paths by A*."""
        at, size = int(self.at[k]), int(self.lens[k])
        rows = [(n, score[at:at + size].tolist()) for n, (_, score) in self.edge.items()]
        alpha = [0.0] + [-np.inf] * size
        for j in range(1, size + 1):
            alpha[j] = max(alpha[j - n] + score[j - n] for n, score in rows if n <= j)
        self.alpha[k] = alpha
        self.best[k] = alpha[size]
        paths = self.paths(k, 2)
        if len(paths) > 1:
            self.loss[k] = paths[0][0] - paths[1][0]
        return np.array([k]), np.array([len(paths[0][1])]), np.array(paths[0][1], np.int64)

    def paths(self, k: int, n_best: int) -> list[tuple[float, list[int]]]:
        """The n best (score, ids) of segment k: A* from the end; the forward score of a place
        is exactly what the rest of the way can add."""
        if hasattr(self, "ids") and k in self.found:
            return self.found[k]
        at, size = int(self.at[k]), int(self.lens[k])
        alpha = self.alpha[k]
        if alpha is None:
            alpha = self._alpha[:size + 1, self._column[k]].tolist()
        heap = [(-alpha[size], 0, (), size, 0.0)]
        out: list[tuple[float, list[int]]] = []
        # paths are linked from the front: (id, position, rest)
        while heap and len(out) < n_best:
            f, count, path, j, g = heapq.heappop(heap)
            if j == 0:
                ids: list[int] = []
                while path:
                    ident, place, path = path
                    ids += [ident] if ident >= 0 else self.lattice.spelled(chr(self.cp[at + place]))
                out.append((-f, ids))
                continue
            for n, (ident, score) in self.edge.items():
                i = j - n
                if i >= 0 and score[at + i] > -np.inf and alpha[i] > -np.inf:
                    step = g + float(score[at + i])
                    heapq.heappush(heap, (-(step + alpha[i]), count + 1, (int(ident[at + i]), i, path), i, step))
        if hasattr(self, "ids"):  # among equal scores the array pass's path comes first
            first = self.ids[self.id_at[k]:self.id_at[k] + self.n_ids[k]].tolist()
            out = [(out[0][0], first), *[x for x in out if x[1] != first]][:n_best]
            self.found[k] = out
        return out


def merged(lists: list[list[tuple[float, list[int]]]], n_best: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best sums of one entry per list: (loss against the best, chosen entries)."""
    start = (0,) * len(lists)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n_best:
        lost, pick = heapq.heappop(heap)
        out.append((lost, pick))
        for d, entries in enumerate(lists):
            if pick[d] + 1 < len(entries):
                new = (*pick[:d], pick[d] + 1, *pick[d + 1:])
                if new not in seen:
                    seen.add(new)
                    more = lost + entries[pick[d]][0] - entries[pick[d] + 1][0]
                    heapq.heappush(heap, (more, new))
    return out


class SegmentStore:
    """Solved segments by fingerprint, kept from slice to slice: prose repeats its words. What a
    store may hold is bounded (``STORE_BYTES``); a fuller one is emptied before the next slice."""

    def __init__(self, lattice: PieceLattice, library: bool):
        self.lattice, self.library = lattice, library
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        self.loss, self.best, self.lib_score = (np.zeros(0) for _ in range(3))
        self.count, self.at, self.lib_count, self.lib_at = (np.zeros(0, np.int64) for _ in range(4))
        self.whole, self.lib_whole = np.zeros(0, bool), np.zeros(0, bool)
        self.ids, self.lib_ids = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.paths: dict[int, list[tuple[float, list[int], bool]]] = {}

    def make_room(self) -> None:
        if 100 * self.n + 8 * (len(self.ids) + len(self.lib_ids)) + 600 * len(self.paths) > STORE_BYTES:
            self.clear()

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The places of segments, -1 where they are not solved yet."""
        if not self.n:
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), self.n - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1)

    def add(self, keys: np.ndarray, cp: np.ndarray, lens: np.ndarray) -> None:
        seg = Segments(self.lattice, cp, lens)
        raw = self._raw(cp, lens)

        def grow(name: str, more: np.ndarray) -> None:
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, more.astype(old.dtype)]))

        grow("loss", seg.loss)
        grow("best", seg.best)
        grow("count", seg.n_ids)
        grow("at", seg.id_at + len(self.ids))
        grow("whole", self._spells(seg.ids, seg.n_ids, *raw))
        grow("ids", seg.ids)
        if self.library:
            count, at, ids, score = seg.library()
            grow("lib_count", count)
            grow("lib_at", at + len(self.lib_ids))
            grow("lib_whole", self._spells(ids, count, *raw))
            grow("lib_ids", ids)
            grow("lib_score", score)
        keys = np.concatenate([self.keys, keys])
        slots = np.concatenate([self.slots, np.arange(self.n, self.n + len(lens))])
        order = np.argsort(keys)
        self.keys, self.slots, self.n = keys[order], slots[order], self.n + len(lens)

    @staticmethod
    def _raw(cp: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of segments with word marks as blanks, and each one's number of bytes."""
        cp = np.where(cp == ord(MARK), 32, cp)
        size = 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)
        text = cp.astype("<u4").tobytes().decode("utf-32-le")
        return np.frombuffer(text.encode(), np.uint8), np.add.reduceat(size, np.cumsum(lens) - lens)

    def _spells(self, ids: np.ndarray, count: np.ndarray, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ids of each segment decode to its bytes."""
        tool = self.lattice
        length = tool.raw_len[ids]
        made = tool.raw[ragged(tool.raw_at[ids], length)]
        owner = np.repeat(np.arange(len(count)), count)
        fits = np.bincount(owner, length, len(count)).astype(np.int64) == size
        if fits.all():
            wrong = np.flatnonzero(made != raw)
            fits[np.searchsorted(np.cumsum(size), wrong, "right")] = False
            return fits
        into, out = np.cumsum(size) - size, np.cumsum(np.bincount(owner, length, len(count)).astype(np.int64))
        begin = out - np.bincount(owner, length, len(count)).astype(np.int64)
        for k in np.flatnonzero(fits).tolist():
            fits[k] = np.array_equal(made[begin[k]:out[k]], raw[into[k]:into[k] + size[k]])
        return fits

    def search(self, slots: np.ndarray, cp: np.ndarray, lens: np.ndarray, n_best: int) -> None:
        """The n best paths of solved segments."""
        seg = Segments(self.lattice, cp, lens)
        raw, size = self._raw(cp, lens)
        into = np.cumsum(size) - size
        for k, slot in enumerate(slots.tolist()):
            plain = raw[into[k]:into[k] + size[k]].tobytes()
            found = seg.paths(k, n_best)
            self.paths[slot] = [(score, ids, self._bytes(ids) == plain) for score, ids in found]

    def _bytes(self, ids: list[int]) -> bytes:
        tool, ids = self.lattice, np.array(ids, np.int64)
        return tool.raw[ragged(tool.raw_at[ids], tool.raw_len[ids])].tobytes()


def solved(store: SegmentStore, texts: list[str], n_best: int) -> list[list[tuple[float, np.ndarray, bool]]]:
    """Per normalised text its n best (score, ids, whether they decode to the text); with a store
    of library encodings, the library's and the n - 1 best others."""
    tool = store.lattice
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out: list[list[tuple[float, np.ndarray, bool]]] = [[(0.0, np.zeros(0, np.int64), True)] for _ in texts]
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    if not len(cp):
        return out
    store.make_room()
    begin = np.cumsum(size) - size
    first = np.zeros(len(cp), bool)
    first[begin[size > 0]] = True
    starts = tool.cuts(cp, first)
    ends = np.append(starts[1:], len(cp))
    keys, at, which = np.unique(RangeHash(cp)(starts, ends), return_index=True, return_inverse=True)
    lens = ends[at] - starts[at]
    slots = store.find(keys)
    new = np.flatnonzero(slots < 0)
    if len(new):
        store.add(keys[new], cp[ragged(starts[at[new]], lens[new])], lens[new])
        slots = store.find(keys)
    owned = slots[which]
    bound = np.searchsorted(starts, np.append(begin, len(cp)))
    close: dict[int, list[int]] = {}
    for k in np.flatnonzero(size).tolist():
        loss = store.loss[owned[bound[k]:bound[k + 1]]]
        few = min(n_best - 1, len(loss))
        near = np.lexsort((np.arange(len(loss)), loss))[:few] if len(loss) < 64 else _smallest(loss, few)
        close[k] = [x for x in near.tolist() if loss[x] < np.inf]
    wanted = {int(which[bound[k] + x]) for k, near in close.items() for x in near}
    wanted = np.array(sorted(x for x in wanted if int(slots[x]) not in store.paths), np.int64)
    if len(wanted):
        store.search(slots[wanted], cp[ragged(starts[at[wanted]], lens[wanted])], lens[wanted], n_best)
    for k, near in close.items():
        own = owned[bound[k]:bound[k + 1]]
        count = store.count[own]
        best = store.ids[ragged(store.at[own], count)]
        total, whole = float(store.best[own].sum()), store.whole[own]
        lists = [store.paths[int(own[x])] for x in near]
        place = np.cumsum(count) - count
        rows = []
        for lost, pick in merged(lists, n_best):
            ids, fits = best, whole
            for x, entries, c in sorted(zip(near, lists, pick), key=lambda y: -y[0]):
                if c:  # from the back, so that earlier places stay
                    ids = np.concatenate([ids[:place[x]], entries[c][1], ids[place[x] + count[x]:]])
                    fits = fits.copy()
                    fits[x] = entries[c][2]
            rows.append((total - lost, ids.astype(np.int64), bool(fits.all())))
        if store.library:
            ids = tool.runs(store.lib_ids[ragged(store.lib_at[own], store.lib_count[own])].astype(np.int64))
            others = [x for x in rows if not np.array_equal(tool.runs(x[1]), ids)]
            rows = [(float(store.lib_score[own].sum()), ids, bool(store.lib_whole[own].all())), *others][:n_best]
        out[k] = rows
    return out


def segmentations(lattice: PieceLattice, texts: list[str], n_best: int,
                  library: bool = False) -> list[list[tuple[float, np.ndarray]]]:
    """Per normalised text its n best (score, ids); with ``library``, the library's encoding and
    the n - 1 best others."""
    found = solved(SegmentStore(lattice, library), texts, n_best)
    return [[(score, ids) for score, ids, _ in rows] for rows in found]


def _smallest(loss: np.ndarray, few: int) -> np.ndarray:
    if few < 1:
        return np.zeros(0, np.int64)
    cut = np.partition(loss, few - 1)[few - 1]
    at = np.flatnonzero(loss <= cut)
    return at[np.lexsort((at, loss[at]))[:few]]


@lru_cache(2)
def lattice(path: str) -> PieceLattice:
    return PieceLattice(path)


def n_best(docs: DataFrame, path: str, n: int = 3, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row and rank: id, rank (from 1, the library's encoding), score, n_pieces, ids_crc32 (unsigned little-endian
    32-bit ids) and whether the ids decode to the normalised text. No shuffle."""
    ident = docs.schema[id_col].dataType.simpleString()
    names = ["i", "rank", "score", "n_pieces", "ids_crc32", "decodes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = lattice(path)
        store = SegmentStore(tool, library=True)
        for batch in batches:
            texts = [tool.normalize(t) for t in batch["t"].to_pylist()]
            for lo, hi in slices(map(len, texts), SLICE_CHARS):
                rows, cols = [], []
                for k, found in enumerate(solved(store, texts[lo:hi], n), lo):
                    for rank, (score, ids, decodes) in enumerate(found, 1):
                        rows.append(k)
                        cols.append((rank, score, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), decodes))
                kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch["i"].take(pa.array(rows, pa.int64())), *map(pa.array, zip(*cols), kinds)], names=names)

    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"i {ident}, rank int, score double, n_pieces long, ids_crc32 long, decodes boolean")
            .withColumnRenamed("i", id_col))

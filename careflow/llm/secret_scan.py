"""Secret scans with one combined deterministic automaton.

Rule patterns are parsed into one NFA, determinised over byte classes by the subset
construction, minimised by partition refinement, and laid out as one transition array. One
byte pass over a batch finds, for every rule at once, all positions where a match may end: the
batch is cut after bytes that send every state back to the start ("reset bytes"), and all
pieces step through the array together. A second automaton of the reversed rules walks back
from an end to the leftmost start.

Rules have the form ``prefix tail+`` with a closed tail alphabet, so all matches that share a
tail share their end; the leftmost non-overlapping matches are then the longest walks back that
do not enter the previous match. Matches that only overlap a dropped one are extra spans.

Defined cases: NULL and empty text hold nothing; texts of any length are scanned whole; rows
are independent (repeats stay repeats); spans are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import slices

SLICE_BYTES = 1 << 22
PIECE = 192       # bytes after which a piece may end at the next reset byte
FEW = 24          # below so many open pieces a plain loop is faster than array steps


@dataclass(frozen=True)
class Rule:
    """``keep`` is the least length of the match, or of its tail for ``by_tail`` rules."""

    kind: str
    pattern: str
    tail: str
    keep: int
    by_tail: bool = False
    any_case: bool = False
    base: bool = True


# The base kinds and their formats, then further published token formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         "A-Za-z0-9+/_.=-", 12, by_tail=True, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", "A-Z0-9", 18),
    Rule("hex", r"[0-9a-f]+", "0-9a-f", 16),
    Rule("git", r"gh[pousr]_[A-Za-z0-9]+", "A-Za-z0-9", 40, base=False),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", "A-Za-z0-9-", 20, base=False),
    Rule("cloud", r"AIza[A-Za-z0-9_-]+", "A-Za-z0-9_-", 39, base=False),
    Rule("payment", r"[sr]k_(live|test)_[A-Za-z0-9]+", "A-Za-z0-9", 24, base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\x2eeyJ[A-Za-z0-9_-]+\x2e[A-Za-z0-9_-]+", "A-Za-z0-9_-", 60, base=False),
    Rule("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-+", "-", 26, base=False),
)
MOST_RULES = 63  # bits of a mask


class _Parser:
    """A byte regex (literals, classes, groups, ``|``, ``?``, ``*``, ``+``) as an NFA fragment
    appended to ``edges``; ``reverse`` builds the reversed language."""

    def __init__(self, pattern: str, any_case: bool, reverse: bool, edges: list, eps: list):
        self.p, self.i, self.fold, self.rev, self.edges, self.eps = pattern, 0, any_case, reverse, edges, eps

    def state(self) -> int:
        self.edges.append([])
        self.eps.append([])
        return len(self.edges) - 1

    def alt(self) -> tuple[int, int]:
        ends = [self.seq()]
        while self.i < len(self.p) and self.p[self.i] == "|":
            self.i += 1
            ends.append(self.seq())
        if len(ends) == 1:
            return ends[0]
        a, b = self.state(), self.state()
        for x, y in ends:
            self.eps[a].append(x)
            self.eps[y].append(b)
        return a, b

    def seq(self) -> tuple[int, int]:
        parts = []
        while self.i < len(self.p) and self.p[self.i] not in "|)":
            parts.append(self.repeat())
        a = b = self.state()
        for x, y in reversed(parts) if self.rev else parts:
            self.eps[b].append(x)
            b = y
        return a, b

    def repeat(self) -> tuple[int, int]:
        x, y = self.atom()
        if self.i < len(self.p) and self.p[self.i] in "?*+":
            op = self.p[self.i]
            self.i += 1
            a, b = self.state(), self.state()
            self.eps[a].append(x)
            self.eps[y].append(b)
            if op != "+":
                self.eps[a].append(b)
            if op != "?":
                self.eps[y].append(x)
            return a, b
        return x, y

    def atom(self) -> tuple[int, int]:
        ch = self.p[self.i]
        if ch == "(":
            self.i += 1
            out = self.alt()
            self.i += 1
            return out
        if ch == "[":
            end = self.p.index("]", self.i + 1)
            chars = char_class(self.p[self.i + 1:end])
            self.i = end + 1
        elif ch == "\\":
            chars = {int(self.p[self.i + 2:self.i + 4], 16)}
            self.i += 4
        else:
            chars = {ord(ch)}
            self.i += 1
        if self.fold:
            chars = {ord(f(chr(c))) for c in chars for f in (str.lower, str.upper)}
        a, b = self.state(), self.state()
        self.edges[a].append((frozenset(chars), b))
        return a, b


def char_class(body: str) -> set[int]:
    out, i = set(), 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            out.update(range(ord(body[i]), ord(body[i + 2]) + 1))
            i += 3
        else:
            out.add(ord(body[i]))
            i += 1
    return out


def _bounded(rule: Rule) -> str:
    """A rule that is its tail alone needs no prefix: its least length goes into the automaton."""
    unit = f"[{rule.tail}]"
    return unit * rule.keep + unit + "*" if rule.pattern == unit + "+" else rule.pattern


class Automaton:
    """Minimal DFA of several rules: ``step[state * 256 + byte]`` and a bit mask of the rules
    that accept in each state. ``search`` lets a match begin at every position."""

    def __init__(self, rules: tuple[Rule, ...], search: bool, reverse: bool = False):
        if len(rules) > MOST_RULES:
            raise ValueError(f"one automaton holds {MOST_RULES} rules, not {len(rules)}")
        edges: list[list] = []
        eps: list[list[int]] = []
        begins, accepts = [], {}
        for k, rule in enumerate(rules):
            a, b = _Parser(_bounded(rule), rule.any_case, reverse, edges, eps).alt()
            begins.append(a)
            accepts[b] = 1 << k
        sets = {chars for e in edges for chars, _ in e}
        signature = [tuple(b in s for s in sets) for b in range(256)]
        kinds = {s: k for k, s in enumerate(dict.fromkeys(signature))}
        byte_kind = np.array([kinds[s] for s in signature])
        sample = [signature.index(s) for s in kinds]

        def closure(states) -> frozenset[int]:
            todo, seen = list(states), set(states)
            while todo:
                for x in eps[todo.pop()]:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            return frozenset(seen)

        start = closure(begins)
        index, table, order = {start: 0}, [], [start]
        for now in order:
            row = []
            for b in sample:
                to = closure([*(begins if search else ()), *(t for s in now for c, t in edges[s] if b in c)])
                if to not in index:
                    index[to] = len(order)
                    order.append(to)
                row.append(index[to])
            table.append(row)
        flags = np.array([sum(accepts.get(x, 0) for x in s) for s in order], np.int64)
        table = np.array(table)
        # partition refinement: split blocks until all members agree on every successor's block
        block = np.unique(flags, return_inverse=True)[1]
        while True:
            _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            finer = finer.ravel()
            if finer.max() == block.max():
                break
            block = finer
        first = np.unique(block, return_index=True)[1]
        swap = np.arange(len(first))  # the start state becomes state 0
        swap[[0, block[0]]] = swap[[block[0], 0]]
        block = swap[block]
        first = first[np.argsort(swap)]
        small = block[table[first]]
        self.n_subsets, self.n_states = len(order), len(first)
        self.step = (small[:, byte_kind] * 256).astype(np.int32).ravel()
        self.accept = np.repeat(flags[first], 256)[::256].astype(np.int64)
        self.accept_at = np.zeros(self.n_states * 256, np.int64)
        self.accept_at[::256] = self.accept
        # the dead state (no accept, no way out) of an anchored automaton
        self.dead = {k * 256 for k in range(self.n_states)
                     if not self.accept[k] and (small[k] == k).all()}
        self.reset = (self.step.reshape(-1, 256) == 0).all(axis=0)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.forward = Automaton(rules, search=True)
        self.back = [Automaton((r,), search=False, reverse=True) for r in rules]
        self._steps = [(b.step.tolist(), b.accept.tolist()) for b in self.back]
        self._list = None

    def ends(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions after which some rule accepts, and their rule masks; ``cuts``: starts of
        texts, each of which begins in the start state."""
        n = len(data)
        resets = np.flatnonzero(self.forward.reset[data]) + 1
        grid = np.arange(0, n, PIECE)
        at = np.searchsorted(resets, grid)
        starts = np.unique(np.concatenate([cuts, resets[at[at < len(resets)]]]))
        starts = starts[starts < n]
        lens = np.append(starts[1:], n) - starts
        order = np.argsort(-lens, kind="stable")
        pos, left = starts[order], lens[order]
        state = np.zeros(len(pos), np.int32)
        found, masks = [], []
        step, accept = self.forward.step, self.forward.accept_at
        live = len(pos)
        t = 0
        while live > FEW:
            state = step[state[:live] + data[pos[:live] + t]]
            mask = accept[state]
            hit = np.flatnonzero(mask)
            if len(hit):
                found.append(pos[hit] + t + 1)
                masks.append(mask[hit])
            t += 1
            live = int(np.searchsorted(-left[:live], -t, side="left"))
        if live:
            if self._list is None:
                self._list = step.tolist(), accept.tolist()
            steps, accepts = self._list
            for k in range(live):
                s, p = int(state[k]) if t else 0, int(pos[k]) + t
                for p, b in enumerate(data[p:pos[k] + left[k]].tobytes(), p + 1):
                    s = steps[s + b]
                    if accepts[s]:
                        found.append(np.array([p]))
                        masks.append(np.array([accepts[s]], np.int64))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, masks = np.concatenate(found), np.concatenate(masks)
        order = np.argsort(found)
        return found[order], masks[order]

    def _start(self, k: int, raw: bytes, end: int, least: int) -> int:
        """The leftmost start >= ``least`` of a match of rule k that ends at ``end``; -1: none."""
        steps, accept = self._steps[k]
        dead = self.back[k].dead
        s, best = 0, -1
        for p in range(end - 1, least - 1, -1):
            s = steps[s + raw[p]]
            if s in dead:
                break
            if accept[s >> 8]:
                best = p
        return best

    def spans(self, texts: list[str]) -> list[tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]]:
        """Per text its base spans and all spans, as (start, kind, end) in code points."""
        raw = [t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        begin = np.cumsum(size) - size
        out: list = [([], []) for _ in texts]
        if not len(data):
            return out
        ends, masks = self.ends(data, begin[size > 0])
        text_of = np.searchsorted(begin, ends - 1, side="right") - 1
        per: dict[int, list[tuple[int, int, int, bool]]] = {}
        for k, rule in enumerate(self.rules):
            sel = masks >> k & 1 == 1
            p, o = ends[sel], text_of[sel]
            if not len(p):
                continue
            last = np.ones(len(p), bool)  # a match ends where its run of accepting positions ends
            last[:-1] = (p[1:] != p[:-1] + 1) | (o[1:] != o[:-1])
            now, free = -1, 0
            for end, own in zip(p[last].tolist(), o[last].tolist()):
                if own != now:
                    now, free = own, 0
                text = raw[own]
                end -= int(begin[own])
                s = self._start(k, text, end, free)
                base = s >= 0
                if not base:
                    s = self._start(k, text, end, 0)
                else:
                    free = end
                length = self._tail(rule, text, s, end) if rule.by_tail else end - s
                if length >= rule.keep:
                    per.setdefault(own, []).append((s, k, end, base and rule.base))
        for own, found in per.items():
            found.sort()
            text = raw[own]
            ascii_only = len(text) == len(texts[own])
            shift = None if ascii_only else np.concatenate(
                [[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            point = (lambda b: b) if ascii_only else (lambda b, c=shift: int(c[b]))
            for s, k, end, base in found:
                span = (point(s), self.rules[k].kind, point(end))
                out[own][1].append(span)
                if base:
                    out[own][0].append(span)
        return out

    @staticmethod
    def _tail(rule: Rule, text: bytes, start: int, end: int) -> int:
        """Length of the value after the separator and its optional blanks and quote."""
        sep = min(x for x in (text.find(b":", start, end), text.find(b"=", start, end)) if x >= 0)
        p = sep + 1
        while text[p:p + 1] == b" ":
            p += 1
        if text[p:p + 1] in (b'"', b"'"):
            p += 1
        return end - p


@lru_cache(4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds, digest of the base spans, all spans."""
    ident = docs.schema[id_col].dataType.simpleString()
    kinds = [r.kind for r in rules if r.base]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(rules)
        for batch in batches:  # ids stay Arrow: pandas would turn longs beside a NULL into doubles
            texts = [t or "" for t in batch["t"].to_pylist()]
            found = []
            for a, b in slices(map(len, texts), SLICE_BYTES):
                found.extend(find.spans(texts[a:b]))
            cols = {"i": batch["i"]}
            for kind in kinds:
                cols[f"n_{kind}"] = pa.array([sum(x[1] == kind for x in base) for base, _ in found], pa.int64())
            cols["base_sha256"] = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found],
                                           pa.string())
            cols["spans"] = pa.array([_joined(every) for _, every in found], pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    counts = "".join(f"n_{kind} long, " for kind in kinds)
    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"i {ident}, {counts}base_sha256 string, spans string")
            .withColumnRenamed("i", id_col))


def mask(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
         size_col: str | None = "n_chars") -> DataFrame:
    """The same rows with every span replaced by ``<kind>``; overlapping spans are masked as
    one, under the first one's kind. ``size_col`` follows the new text where a span was found."""
    names = docs.columns

    def masked(text: str, spans: list[tuple[int, str, int]]) -> str:
        parts, at = [], 0
        for s, kind, e in spans:
            if s >= at:
                parts += [text[at:s], f"<{kind}>"]
            at = max(at, e)
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(rules)
        for batch in batches:  # other columns pass through as they are
            texts = batch[text_col].to_pylist()
            new: dict[int, str] = {}
            for a, b in slices((len(t or "") for t in texts), SLICE_BYTES):
                for k, (_, spans) in enumerate(find.spans([t or "" for t in texts[a:b]]), a):
                    if spans:
                        new[k] = masked(texts[k], spans)
            if new:
                cols = {name: batch[name] for name in names}
                kind = cols[text_col].type
                cols[text_col] = pa.array([new.get(k, t) for k, t in enumerate(texts)], kind)
                if size_col in cols:
                    old = cols[size_col].to_pylist()
                    cols[size_col] = pa.array([len(new[k]) if k in new else n for k, n in enumerate(old)],
                                              cols[size_col].type)
                batch = pa.RecordBatch.from_arrays(list(cols.values()), names)
            yield batch

    return docs.mapInArrow(run, docs.schema)

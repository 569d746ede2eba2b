"""Periodic runs of words: every maximal repetition of each text, by recompression and harmonic-grid candidates.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) whose length is at
least ``max(12, 2 q)`` and that no neighbouring word extends keeping that period.

*Grammar.* The words of some whole texts, parted by symbols that occur once, are recompressed: block compression puts one
symbol for each stretch of an equal symbol, pair compression one for each pair of a left and a right symbol, in turns,
until no two symbols of a text are left to pair. Equal symbols stand for equal stretches, and what becomes of a symbol
depends on its neighbours alone, so two equal stretches are parsed alike but for their ends. The levels are a run-length
grammar of the texts.

*Extensions.* How far two places agree, forward or backward, is found by climbing the levels as long as both places are
at an edge of a larger symbol (past a few symbols, or past a block at once) and descending again from the first level
that differs: a number of steps in the logarithm of the length. All queries take each step together.

*Candidates.* A run of period ``p`` is at least ``2 p`` long, so it holds two places ``k p`` and ``(k + 1) p`` of the grid
of multiples of ``p``, which agree. These are ``n + n/2 + n/3 + ...`` places; where they agree, exact extensions both
ways give the run. An interval that several periods find is a run of the least.

Texts do not meet, so there is no shuffle and no collected group. Texts are worked on together up to ``WORDS_AT_ONCE``
words and never cut: a task holds about 150 bytes for each word of its longest text.

Defined cases: a null or empty text, or one of white space, has no words and no run; ``collapsed_sha256`` and
``runs_sha256`` are then digests of nothing; a null id gets no planted period; repeated rows give repeated results; of
runs of one length the first one is named, then the one of least period; an empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import bytes_of, table

LEAST = 12  # words of a run
WORDS_AT_ONCE = 200_000
QUERIES_AT_ONCE = 500_000


# ---------------------------------------------------------------- recompression


class Level:
    """Symbols of one level, and where each lies in the one above."""

    __slots__ = ("symbols", "up", "first", "last", "blocks")

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.up = self.first = self.last = None
        self.blocks = False


def _side(symbols: np.ndarray, salt: int) -> np.ndarray:
    """Is a symbol a left one in this turn? A mix of its number, alike wherever it stands."""
    x = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """Levels of a sequence in which symbols below ``singles`` occur once, never to be joined."""

    def __init__(self, symbols: np.ndarray, singles: int):
        self.levels = [Level(symbols.astype(np.int64))]
        self.next = int(symbols.max(initial=0)) + 1
        self.singles = singles
        turn = 0
        while self._block() | self._pair(turn):
            turn += 1

    def _climb(self, starts: np.ndarray, names: np.ndarray, blocks: bool) -> None:
        level = self.levels[-1]
        level.blocks = blocks
        level.up = (np.cumsum(starts) - 1).astype(np.int32)
        level.first = np.flatnonzero(starts).astype(np.int32)
        level.last = np.append(level.first[1:], len(starts)).astype(np.int32) - 1
        self.levels.append(Level(names))

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """New symbols, one for each different key."""
        different, which = np.unique(keys, return_inverse=True)
        self.next += len(different)
        return which + (self.next - len(different))

    def _block(self) -> bool:
        symbols = self.levels[-1].symbols
        same = np.zeros(len(symbols), bool)
        same[1:] = symbols[1:] == symbols[:-1]
        if not same.any():
            return False
        first = np.flatnonzero(~same)
        length = np.diff(np.append(first, len(symbols)))
        names = symbols[first].copy()
        many = np.flatnonzero(length > 1)
        names[many] = self._named(names[many] * np.int64(len(symbols) + 1) + length[many])
        self._climb(~same, names, True)
        return True

    def _pair(self, turn: int) -> bool:
        symbols = self.levels[-1].symbols
        free = symbols >= self.singles
        able = free[1:] & free[:-1]
        if not able.any():
            return False
        left = _side(symbols, turn)
        one, other = able & left[:-1] & ~left[1:], able & ~left[:-1] & left[1:]
        second = np.zeros(len(symbols), bool)
        second[1:] = one if one.sum() >= other.sum() else other
        at = np.flatnonzero(second)
        if len(at):
            names = symbols.copy()
            names[at - 1] = self._named(symbols[at - 1] * np.int64(self.next) + symbols[at])
            self._climb(~second, names[~second], False)
        return True

    def agree(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols agree from places ``a`` and ``b`` on; backward: how many end there, both places included."""
        step = 1 if forward else -1
        home = a
        stop = np.empty(len(a), np.int64)  # level at which the climb of each query ends
        at_a, at_b = a.copy(), b.copy()
        going = np.arange(len(a))
        for t, level in enumerate(self.levels):
            if level.up is None:  # the top: what is left is compared symbol by symbol
                stop[going] = t
                break
            edge = level.first if forward else level.last
            x, y = at_a[going], at_b[going]
            aligned = (edge[level.up[x]] == x) & (edge[level.up[y]] == y)
            busy = np.flatnonzero(~aligned)
            while len(busy):
                busy = busy[level.symbols[x[busy]] == level.symbols[y[busy]]]
                by = self._stride(level, x[busy], y[busy], forward)
                x[busy] += by
                y[busy] += by
                there = (edge[level.up[x[busy]]] == x[busy]) & (edge[level.up[y[busy]]] == y[busy])
                aligned[busy[there]] = True
                busy = busy[~there]
            at_a[going], at_b[going] = x, y
            stop[going[~aligned]] = t
            going = going[aligned]
            at_a[going], at_b[going] = level.up[x[aligned]], level.up[y[aligned]]
            if not len(going):
                break
        for t in range(int(stop.max(initial=0)), -1, -1):
            level = self.levels[t]
            here = np.flatnonzero(stop == t)
            x, y = at_a[here], at_b[here]
            busy = np.arange(len(here))
            while len(busy):
                busy = busy[level.symbols[x[busy]] == level.symbols[y[busy]]]
                by = self._stride(level, x[busy], y[busy], forward)
                x[busy] += by
                y[busy] += by
            if t:
                below = self.levels[t - 1]
                edge = below.first if forward else below.last
                x, y = edge[x], edge[y]
                stop[here] = t - 1
            at_a[here], at_b[here] = x, y
        return (at_a - home) * step

    @staticmethod
    def _stride(level: Level, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """Symbols to pass where ``x`` and ``y`` agree: one, or as many of an equal block as both still have."""
        if not level.blocks:
            return np.full(len(x), 1 if forward else -1)
        up, far = level.up, level.last if forward else level.first
        if forward:
            return np.minimum(far[up[x]] - x, far[up[y]] - y) + 1
        return -(np.minimum(x - far[up[x]], y - far[up[y]]) + 1)


# ---------------------------------------------------------------- runs


def runs(texts: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of some sequences of numbers from 0: ``text, start, length, period``, by text, start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    singles = len(texts) + 1
    starts = np.cumsum(sizes + 1) - sizes  # one single symbol before each text and one at the end
    line = np.zeros(int(sizes.sum()) + singles, np.int64)
    line[np.append(starts - 1, len(line) - 1)] = np.arange(singles)
    for t, at in zip(texts, starts.tolist()):
        line[at:at + len(t)] = t + singles
    most = int(sizes.max(initial=0)) // 2
    if most < 1:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    grammar = Grammar(line, singles)
    found = np.empty((0, 3), np.int64)  # start, end, period
    held: list[tuple[np.ndarray, int]] = []
    waiting = 0
    for p in range(1, most + 1):
        places = np.flatnonzero(line[:-p:p] == line[p::p]) * p
        if len(places):
            held.append((places, p))
            waiting += len(places)
        if held and (waiting >= QUERIES_AT_ONCE or p == most):
            at = np.concatenate([h for h, _ in held])
            period = np.repeat([q for _, q in held], [len(h) for h, _ in held])
            found = _least(np.concatenate([found, _extended(grammar, at, period, least)]))
            held, waiting = [], 0
    text = np.searchsorted(starts, found[:, 0], side="right") - 1
    order = np.lexsort((found[:, 2], found[:, 0]))
    text, found = text[order], found[order]
    return text, found[:, 0] - starts[text], found[:, 1] - found[:, 0], found[:, 2]


def _extended(grammar: Grammar, at: np.ndarray, period: np.ndarray, least: int) -> np.ndarray:
    """Runs through agreeing grid places ``at`` and ``at + period``."""
    ahead = grammar.agree(at, at + period, True)
    back = grammar.agree(at, at + period, False) - 1
    length = period + ahead + back
    good = length >= np.maximum(least, 2 * period)
    start = (at - back)[good]
    return np.stack([start, start + length[good], period[good]], axis=1)


def _least(found: np.ndarray) -> np.ndarray:
    """Every interval once, with its least period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a period of the contract's rule put into one document of ten."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a:a + p]
    return words[:a] + (again * ((n - a) // len(again) + 1))[:n - a]


# ---------------------------------------------------------------- Spark

_OUT = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
        "collapsed_sha256 string, collapsed string")


def _grouped(texts: list[bytes], ids: list, plant: bool) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in order, as many texts at a time as hold ``WORDS_AT_ONCE`` words."""
    part: list[list[bytes]] = []
    words = 0
    for text, i in zip(texts, ids):
        own = text.split()  # bytes part at space and U+0009 to U+000D alone
        if plant:
            own = planted(own, i)
        if part and words + len(own) > WORDS_AT_ONCE:
            yield part
            part, words = [], 0
        part.append(own)
        words += len(own)
    if part:
        yield part


def _rows(part: list[list[bytes]], least: int) -> Iterator[tuple]:
    number = defaultdict(count().__next__)
    coded = [np.fromiter(map(number.__getitem__, own), np.int64, len(own)) for own in part]
    text, start, length, period = runs(coded, least)
    ends = np.searchsorted(text, np.arange(len(part) + 1))
    nothing = hashlib.sha256().hexdigest()
    for i, own in enumerate(part):
        lo, hi = int(ends[i]), int(ends[i + 1])
        if lo == hi:
            kept = b" ".join(own)
            yield 0, None, None, None, None, nothing, hashlib.sha256(kept).hexdigest(), kept
            continue
        s, m, q = start[lo:hi], length[lo:hi], period[lo:hi]
        kept = b" ".join([w for w, gone in zip(own, dropped(len(own), s, m, q).tolist()) if not gone])
        best = int(np.lexsort((q, s, -m))[0])
        lines = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), m.tolist(), q.tolist()))
        yield (hi - lo, int(s[best]), int(m[best]), int(q[best]), 1000 * int(m[best]) // int(q[best]),
               hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), kept)


def periodic_runs(docs: DataFrame, least: int = LEAST, plant: bool = False, id_column: str = "doc_id",
                  text_column: str = "text", collapsed: bool = True) -> DataFrame:
    """Runs of every whole text: their number, the longest one, digests, and the text without what runs repeat.

    ``plant`` puts a period into one document of ten first, by a rule on its id. ``collapsed`` asks for the text itself
    beside its digest.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            lo = 0
            for part in _grouped(bytes_of(batch.column(1)), ids, plant):
                out = list(zip(*_rows(part, least)))
                columns = [pa.array(c, pa.int64()) for c in out[:5]] + [pa.array(c, pa.string()) for c in out[5:7]]
                columns += [pa.array(out[7], pa.binary()).cast(pa.string())] if collapsed else []
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(part)), *columns], names)
                lo += len(part)

    out = _OUT if collapsed else _OUT.rpartition(",")[0]
    names = ["doc_id", *[c.split()[0] for c in out.split(", ")]]
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {out}")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten with a planted period."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True, collapsed=False)


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
SQL: dict[str, str] = {}  # maximal runs are beyond SQL; tested against brute force

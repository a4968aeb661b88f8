"""Periodic runs of words, found on a harmonic grid with common extensions.

A run is a stretch of words that repeats with a smallest period q, cannot be extended
by a neighbouring word, and is at least ``max(MIN_WORDS, 2 * q)`` words long. Every
run of period p holds two neighbouring multiples of p, so it is enough to ask, for
each p and each multiple i of p, how far words at distance p agree from i onwards and
before i. There are about n log n such pairs in n words; most are refuted by their
first words.

The questions are answered by a difference cover: of every ``COVER_SIZE`` positions
only those in ``COVER`` have their suffixes sorted, with an array of common prefixes
and a sparse table of range minima over it. Two positions meet sampled ones less than
``COVER_SIZE`` words on, after which one range minimum gives the rest.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
# Differences of these four residues give every residue modulo 13.
COVER_SIZE = 13
COVER = (0, 1, 3, 9)
#: Texts are taken together up to about so many bytes, grid pairs up to so many at once.
SLICE_BYTES = 1 << 20
PAIRS = 1 << 21

_C = len(COVER)
_SLOT = np.full(COVER_SIZE, -1)
_SLOT[list(COVER)] = range(_C)
#: Least step after which both residues are in the cover.
_STEP = np.array(
    [
        [
            next(d for d in range(COVER_SIZE) if _SLOT[(a + d) % COVER_SIZE] >= 0 <= _SLOT[(b + d) % COVER_SIZE])
            for b in range(COVER_SIZE)
        ]
        for a in range(COVER_SIZE)
    ]
)
_BREAK = re.compile(rb"[ \t-\r]")


class Extensions:
    """Lengths of common extensions of two positions in an array of word numbers.

    Texts in the array must each end with a number found nowhere else.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        blocks = n // COVER_SIZE + 1
        padding = np.arange(blocks * COVER_SIZE + 2 * COVER_SIZE - n) + (words.max(initial=0) + 1)
        self.words = np.concatenate((words, padding)).astype(np.int64)
        starts = (np.arange(blocks)[:, None] * COVER_SIZE + COVER).ravel()
        self.rank, lcp = self._sorted(starts)
        self.minima = [lcp]
        while 2 << len(self.minima) - 1 <= len(lcp):
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _sorted(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each sampled suffix, and common blocks of each with the next in rank.

        ``COVER_SIZE`` words are one letter; ranks double the number of letters that they
        cover until all are different.
        """
        m, span = len(starts), int(self.words.max()) + 1
        rank = np.unique(self.words[starts], return_inverse=True)[1]
        for k in range(1, COVER_SIZE):
            rank = np.unique(rank * span + self.words[starts + k], return_inverse=True)[1]
        levels = [rank.astype(np.int32)]
        while rank.max() < m - 1:
            step = _C << len(levels) - 1
            after = np.zeros(m, np.int64)
            after[: m - step] = rank[step:] + 1
            rank = np.unique(rank * (m + 1) + after, return_inverse=True)[1]
            levels.append(rank.astype(np.int32))
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(m - 1, np.int32)
        for k in range(len(levels) - 2, -1, -1):
            same = levels[k][a] == levels[k][b]
            lcp += same.astype(np.int32) << k
            a += same * (_C << k)
            b += same * (_C << k)
        return levels[-1], lcp

    def _common_blocks(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Blocks that two different sampled positions have in common."""
        a = self.rank[i // COVER_SIZE * _C + _SLOT[i % COVER_SIZE]]
        b = self.rank[j // COVER_SIZE * _C + _SLOT[j % COVER_SIZE]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(hi - lo)[1] - 1
        found = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.minima[k]
            found[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k)])
        return found

    def _step_by_step(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, ``most`` at most."""
        found = np.zeros(len(i), np.int64)
        on = np.arange(len(i))
        for t in range(int(most.max(initial=0))):
            on = on[most[on] > t]
            on = on[self.words[i[on] + t] == self.words[j[on] + t]]
            found[on] += 1
        return found

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and from j on, for i different from j."""
        step = _STEP[i % COVER_SIZE, j % COVER_SIZE]
        found = self._step_by_step(i, j, step)
        on = np.flatnonzero(found == step)
        i, j = i[on] + step[on], j[on] + step[on]
        skipped = self._common_blocks(i, j) * COVER_SIZE
        rest = self._step_by_step(i + skipped, j + skipped, np.full(len(i), COVER_SIZE))
        found[on] += skipped + rest
        return found


def _grid(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
    """Pairs (i, p): words i and i + p agree, so does a pair beside them, and i lies on
    the grid of p in its text."""
    halves = sizes // 2
    text = np.repeat(np.arange(len(sizes)), halves)
    first = np.cumsum(halves) - halves
    p = np.arange(len(text)) - np.repeat(first, halves) + 1
    number = (sizes[text] - 1) // p
    ends = np.cumsum(number)
    at = 0
    while at < len(p):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        n = number[at:to]
        period = np.repeat(p[at:to], n)
        step = np.arange(len(period)) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(starts[text[at:to]], n) + step * period
        on = np.flatnonzero(words[i] == words[i + period])
        i, period = i[on], period[on]
        # The number that ends a text agrees with no other, nor does the one before it.
        on = (words[i + 1] == words[i + 1 + period]) | (words[i - 1] == words[i - 1 + period])
        yield i[on], period[on]
        at = to


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row, each ended by a number of its own, as is the one before the
    first; where each starts, and its size."""
    sizes = np.array([len(t) for t in texts], np.int64)
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    parts = [np.array([top])]
    for k, t in enumerate(texts):
        parts += [t, np.array([top + 1 + k])]
    return np.concatenate(parts).astype(np.int64), 1 + np.cumsum(sizes + 1) - (sizes + 1), sizes


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period) of every run of each text, by start, then period.

    A text is an array of word numbers from 0 on.
    """
    found: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(texts)
    words, starts, sizes = _joined(texts)
    # Only texts with a pair that is left are sorted.
    wanted = np.zeros(len(texts), bool)
    for i, _ in _grid(words, starts, sizes):
        wanted[np.searchsorted(starts, i, side="right") - 1] = True
    numbers = np.flatnonzero(wanted)
    if len(numbers) == 0:
        return found
    words, starts, sizes = _joined([texts[k] for k in numbers])
    _, words = np.unique(words, return_inverse=True)
    n = len(words)
    onwards, backwards = Extensions(words), Extensions(words[::-1])
    runs = np.empty((0, 4), np.int64)
    for i, p in _grid(words, starts, sizes):
        onward, before = onwards.common(i, i + p), backwards.common(n - i, n - i - p)
        long = onward + before >= np.maximum(p, MIN_WORDS - p)
        i, p, before, onward = (x[long] for x in (i, p, before, onward))
        text = np.searchsorted(starts, i, side="right") - 1
        met = np.stack((text, i - before - starts[text], onward + before + p, p), axis=1)
        # A run is met at each multiple of its period, and under multiples of the period.
        runs = np.unique(np.concatenate((runs, met)), axis=0)
        smallest = np.ones(len(runs), bool)
        smallest[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
        runs = runs[smallest]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    cuts = np.searchsorted(runs[:, 0], np.arange(len(numbers) + 1))
    for k, t in enumerate(numbers):
        found[t] = runs[cuts[k] : cuts[k + 1], 1:]
    return found


def left_over(size: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: words of a run behind its first period go."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _numbers(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    """Number of each word; a long text is split piece by piece."""
    parts, at = [np.empty(0, np.int32)], 0
    while at < len(text):
        cut = _BREAK.search(text, at + SLICE_BYTES) if at + SLICE_BYTES < len(text) else None
        to = cut.start() if cut else len(text)
        words = text[at:to].split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        at = to
    return np.concatenate(parts)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of every whole text, and the text without their repeated words.

    Words are separated by ASCII white space and compared byte by byte. Result: one row
    per row with ``id``, ``n_words``, ``runs`` (array of start, length and period in
    words, by start, then period) and ``collapsed``: the words that are in no run, or
    only in the first period of runs, joined by one space. A NULL text is empty: no
    words, no runs, an empty ``collapsed``. Rows are independent of each other, so there
    is no shuffle; memory follows the longest single text.
    """

    def part(texts: list[bytes]) -> list[pa.Array]:
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        numbers = [_numbers(t, known) for t in texts]
        words = list(known)
        runs = find_runs(numbers)
        collapsed = [
            b" ".join([words[k] for k in (n[left_over(len(n), r)] if len(r) else n)])
            for n, r in zip(numbers, runs, strict=True)
        ]
        flat = np.concatenate([np.empty((0, 3), np.int64), *runs])
        ends = np.cumsum([0, *map(len, runs)])
        made = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
        return [
            pa.array([len(n) for n in numbers], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1])
            ends = np.cumsum(sizes)
            at = 0
            while at < len(texts):
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
                made = part(texts.slice(at, to - at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, to - at), *made], names=["id", "n_words", "runs", "collapsed"]
                )
                at = to

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"id {kind}, n_words LONG, runs ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>, "
        "collapsed STRING",
    ).withColumnRenamed("id", id)

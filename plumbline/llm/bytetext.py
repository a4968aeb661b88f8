"""Text columns as byte arrays: words, hashes and n-grams for whole batches at once.

A batch of texts is one array of UTF-8 bytes with the offset of each text. Work
goes over slices of a bounded number of bytes, so memory follows the longest
single text and never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240521).integers(
    1, 1 << 63, 256, dtype=np.uint64
) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


@dataclass(frozen=True)
class Texts:
    """Texts ``first`` and on of a batch: their bytes, and where each begins and ends."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text, counted from 0, that holds each byte position."""
        return np.searchsorted(self.offsets, positions, side="right") - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into slices of at most ``limit`` bytes, or of one text.

    NULL counts as the empty text.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        own = offsets[at : to + 1]
        yield Texts(data[own[0] : own[-1]], own - own[0], at)
        at = to


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < size:
        grown = max(size, SLICE_BYTES + 1)
        known = np.cumprod(np.concatenate(([np.uint64(1)], np.full(grown - 1, base))))
        if grown > 8 * SLICE_BYTES:
            return known
        _powers[name] = known
    return known[:size]


@dataclass(frozen=True)
class Words:
    """White-space separated words: hash, text they belong to, and byte range."""

    hashes: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words(texts: Texts, fold: bool = True, breaks: np.ndarray | None = None) -> Words:
    """Hash every word of every text. ``fold`` lower-cases A-Z first.

    A word is a run of bytes other than ASCII white space (or than ``breaks``). Its
    64-bit hash is a polynomial in random values of its bytes, taken from running
    sums, so the cost does not depend on the number of words.
    """
    data = _LOWER[texts.data] if fold else texts.data
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, none)
    gap = (_SPACE if breaks is None else breaks)[data]
    edges = texts.offsets[1:-1]
    edges = edges[edges < n]
    opens = np.empty(n, bool)
    opens[0] = True
    opens[1:] = gap[:-1]
    opens[edges] = True
    closes = np.empty(n, bool)
    closes[-1] = True
    closes[:-1] = gap[1:]
    closes[edges[edges > 0] - 1] = True
    starts = np.flatnonzero(opens & ~gap)
    ends = np.flatnonzero(closes & ~gap) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[data] * _power("up", _BASE, n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power("down", _BASE_INVERSE, n)[starts])
    return Words(hashes, texts.owner(starts), starts, ends)


def spans(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word, and hash, of every ``size`` words in a row of one text.

    The hash comes from running sums too, so the cost does not depend on ``size``.
    """
    n = len(w.hashes)
    if n < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(w.owner[size - 1 :] == w.owner[: n - size + 1])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hashes * _power("up", _BASE, n), out=sums[1:])
    return at, mix((sums[at + size] - sums[at]) * _power("down", _BASE_INVERSE, n)[at])


def shingles(w: Words, size: int, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row, and the text of each, grouped by text.

    A text with fewer words, but some, has one shingle of all its words.
    """
    h, owner = w.hashes, w.owner
    counts = np.bincount(owner, minlength=n_texts)
    full = np.empty(0, np.uint64)
    at = np.empty(0, np.int64)
    if len(h) >= size:
        inside = np.flatnonzero(owner[size - 1 :] == owner[: len(owner) - size + 1])
        full = np.zeros(len(inside), np.uint64)
        for k in range(size):
            full = mix(full * np.uint64(3) + h[inside + k])
        at = owner[inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        ends = np.cumsum(counts)
        few = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            few[has] = mix(few[has] * np.uint64(3) + h[ends[short[has]] - counts[short[has]] + k])
        full, at = np.concatenate((full, mix(few + np.uint64(1)))), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        full, at = full[order], at[order]
    return full, at


def distinct_sets(values: np.ndarray, at: np.ndarray, n_texts: int) -> list[np.ndarray]:
    """Sorted distinct values of each text."""
    order = np.lexsort((values, at))
    values, at = values[order], at[order]
    keep = np.empty(len(values), bool)
    if len(values):
        keep[0] = True
        keep[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1])
    values, at = values[keep], at[keep]
    return np.split(values, np.searchsorted(at, np.arange(1, n_texts)))

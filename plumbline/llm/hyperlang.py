"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product of its
letters' vectors, each rotated by its place; a text is the sum of its trigrams, a
language the sum of its labelled texts, each with equal weight. Texts go to the
language whose prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bytetext import Texts, slices
from plumbline.llm.workers import lean

DIMENSIONS = 1024
UNDETERMINED = "und"
#: A text adds its trigrams' shares in these units, so sums are whole numbers.
UNITS = 1 << 16
_SLICE = 1 << 19
#: Texts, and trigrams, that are worked on together.
_TEXTS = 512
_AT_ONCE = 4096

_worker: dict = {}


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    if "letters" not in _worker:
        table = np.zeros(0x110000, np.int32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                table[point] = ord(c.lower()[0])
        _worker["letters"] = table
    return _worker["letters"]


def _vector(letter: int) -> np.ndarray:
    """The letter's random vector; 0 is the gap between words."""
    known = _worker.setdefault("vectors", {})
    if letter not in known:
        bits = np.random.default_rng([577, letter]).integers(0, 2, DIMENSIONS, dtype=np.int8)
        known[letter] = bits * np.int8(2) - np.int8(1)
    return known[letter]


def _parts(column: pa.Array) -> Iterator[Texts]:
    """Slices of a bounded number of texts and of bytes, or of one text."""
    for at in range(0, len(column), _TEXTS):
        for part in slices(column.slice(at, _TEXTS), _SLICE):
            yield Texts(part.data, part.offsets, at + part.first)


def _codes(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and code of every trigram, and the letters that the codes count in.

    Runs of other characters are one gap; a text starts and ends with a gap.
    """
    n = len(part)
    text = part.data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    first_byte = np.flatnonzero((part.data & 0xC0) != 0x80)
    owner = part.owner(first_byte)
    letters = _letters()[points]
    # One gap before each text and one after the last.
    at = np.searchsorted(owner, np.arange(n))
    letters = np.concatenate((np.insert(letters, at, 0), [0]))
    owner = np.concatenate((np.insert(owner, at, np.arange(n)), [n]))
    # Of gaps next to each other the last stays: it belongs to the text that goes on.
    keep = np.ones(len(letters), bool)
    keep[:-1] = (letters[:-1] != 0) | (letters[1:] != 0)
    letters, owner = letters[keep], owner[keep]
    used = np.unique(letters)
    code = np.searchsorted(used, letters)
    if len(code) < 3 or len(used) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64), used
    middle = owner[1:-1]
    triple = (code[:-2] * len(used) + code[1:-1]) * len(used) + code[2:]
    # A trigram lies in its middle letter's text, or ends with the gap after that text.
    inside = (owner[:-2] == middle) & ((owner[2:] == middle) | (letters[2:] == 0))
    return middle[inside], triple[inside], used


def _trigrams(part: Texts) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The number of trigrams of each text; and, for some trigrams at a time, how often each
    text has them, and their vectors. Memory does not follow the number of trigrams."""
    n = len(part)
    owner, triple, used = _codes(part)
    total = np.bincount(owner, minlength=n)

    def some() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(triple) == 0:
            return
        order = np.argsort(triple, kind="stable")
        ordered, holder = triple[order], owner[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        found, index = ordered[new], np.cumsum(new) - 1
        size = len(used)
        letters = np.stack([_vector(int(x)) for x in used])
        for at in range(0, len(found), _AT_ONCE):
            lo, hi = np.searchsorted(index, [at, at + _AT_ONCE])
            held = found[at : at + _AT_ONCE]
            cell = holder[lo:hi] * len(held) + index[lo:hi] - at
            counts = np.bincount(cell, minlength=n * len(held)).reshape(n, len(held))
            vectors = np.roll(letters[held // (size * size)], 2, axis=1)
            vectors = vectors * np.roll(letters[held // size % size], 1, axis=1) * letters[held % size]
            yield counts.astype(np.float32), vectors.astype(np.float32)

    return total, some()


def profiles(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of each text, and its number of trigrams (0: no letter)."""
    total, some = _trigrams(part)
    bundle = np.zeros((len(part), DIMENSIONS), np.float32)
    for counts, vectors in some:
        bundle += counts @ vectors
    return bundle, total


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their prototypes of length 1, from all rows with a ``lang``.

    Tasks add up whole numbers per language and dimension; the driver gets one number
    for each of those, so what it holds follows the number of languages alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for part in _parts(batch.column(0)):
                total, some = _trigrams(part)
                units = (UNITS / np.maximum(total, 1).astype(np.float32))[:, None]
                own = np.array(labels[part.first : part.first + len(part)], object)
                masks = {name: own == name for name in set(own)}
                for counts, vectors in some:
                    share = np.rint(counts * units)
                    for name, mine in masks.items():
                        made = share[mine].sum(axis=0, dtype=np.float64) @ vectors.astype(np.float64)
                        sums[name] = sums.get(name, 0) + made.astype(np.int64)
        for name, made in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * DIMENSIONS),
                    "dim": pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                    "v": pa.array(made),
                }
            )

    rows = docs.where(F.col(lang).isNotNull()).select(
        F.coalesce(text, F.lit("")).alias("t"), F.col(lang).alias("lang")
    )
    table = (
        rows.mapInArrow(lean(run), "lang STRING, dim INT, v LONG")
        .groupBy("lang", "dim")
        .agg(F.sum("v").alias("v"))
        .orderBy("lang", "dim")
        .toArrow()
    )
    names = sorted(set(table.column("lang").to_pylist()))
    sums = np.asarray(table.column("v"), np.float64).reshape(len(names), DIMENSIONS)
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    seen = norms[:, 0] > 0
    return [x for x, s in zip(names, seen, strict=True) if s], (sums / np.maximum(norms, 1))[seen]


def predict(
    docs: DataFrame,
    languages: list[str],
    prototypes: np.ndarray,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score``, the best cosine cut to 0..1.

    ``und`` with score 0 for a text that is NULL or has no letter, or if nothing was
    learned. Ties go to the first language in order. One row per row that goes in.
    """
    model = prototypes.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for part in _parts(batch.column(batch.num_columns - 1)):
                bundle, n = profiles(part)
                if not languages:
                    names += [UNDETERMINED] * len(part)
                    scores += [0.0] * len(part)
                    continue
                norm = np.maximum(np.linalg.norm(bundle, axis=1, keepdims=True), 1e-9)
                cosine = (bundle / norm) @ model.T
                best = cosine.argmax(axis=1)
                top = np.clip(cosine[np.arange(len(best)), best], 0, 1)
                for k in range(len(part)):
                    names.append(languages[best[k]] if n[k] else UNDETERMINED)
                    scores.append(float(top[k]) if n[k] else 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    rows = docs.select(*keep, F.coalesce(text, F.lit("")).alias("__text"))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(lean(run), ", ".join([*kinds, "lang_pred STRING", "score DOUBLE"]))

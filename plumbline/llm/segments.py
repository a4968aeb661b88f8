"""Passages that repeat across documents, wherever lines begin and end.

Texts are cut before words whose hash is the smallest of the words around them, so a
passage is cut alike wherever it stands, but for its two ends. Two segments in a row
are one unit, told by the hash of its words: units are so short that word n-grams at a
similarity of 0.8 leave room for hardly any other text. Units found in one text only
are left out; neighbouring units that are left grow together to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bytetext import _BASE, _BASE_INVERSE, Texts, _power, mix, slices, words
from plumbline.llm.paragraphs import _points
from plumbline.llm.storage import Stored
from plumbline.llm.workers import lean, parts_of

#: A word is cut before if its hash is the smallest of so many words on either side.
AROUND = 4
#: Words in whole units that make a passage. One of 50 words has about nine words to a
#: segment and loses a part of one at each end.
MIN_WORDS = 24


def _units(part: Texts, around: int) -> tuple[np.ndarray, ...]:
    """Owner, key, words and byte range of every two segments in a row."""
    w = words(part)
    n, size = len(w.hashes), 2 * around + 1
    if n < size:
        return (np.empty(0, np.int64),) * 5
    least = np.lib.stride_tricks.sliding_window_view(w.hashes, size).argmin(axis=1) == around
    inside = w.owner[size - 1 :] == w.owner[: n - size + 1]
    cuts = np.flatnonzero(least & inside) + around
    first, past = cuts[:-2], cuts[2:]
    own = w.owner[first] == w.owner[past]
    first, past = first[own], past[own]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hashes * _power("up", _BASE, n), out=sums[1:])
    key = (sums[past] - sums[first]) * _power("down", _BASE_INVERSE, n)[first]
    key = mix(key + (past - first).astype(np.uint64))
    return w.owner[first], key, np.stack((first, past), axis=1), w.starts[first], w.ends[past - 1]


def _placed(docs: DataFrame, around: int) -> DataFrame:
    """A row per text: its units' keys, and their packed places (first and last word, first
    and last code point)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                owner, key, span, start, end = _units(part, around)
                texts, at = np.unique(owner, return_index=True)
                if not len(texts):
                    continue
                place = np.concatenate(
                    (span, _points(part, owner, start)[:, None], _points(part, owner, end)[:, None]),
                    axis=1,
                )
                # Words count from the text's own first unit.
                place[:, :2] -= np.repeat(place[at, :1], np.diff([*at, len(owner)]), axis=0)
                steps = place.copy()
                steps[1:, 0] -= place[:-1, 0]
                steps[1:, 2] -= place[:-1, 2]
                steps[at] = place[at]
                steps[:, 1] -= place[:, 0]
                steps[:, 3] -= place[:, 2]
                packed = [x.astype("<i4").tobytes() for x in np.split(steps, at[1:])]
                rows = pa.array(texts + part.first, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.ListArray.from_arrays(
                            np.append(at, len(key)).astype(np.int32), pa.array(key.view(np.int64))
                        ),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["id", "row", "keys", "places"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(lean(run), f"id {kind}, row LONG, keys ARRAY<LONG>, places BINARY")


def _grown(rows: DataFrame, min_words: int) -> DataFrame:
    """Passages of each text from its units that are found again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            texts: list[int] = []
            made: list[tuple] = []
            for k in range(batch.num_rows):
                found = grown(batch.column(1)[k].as_py(), batch.column(2)[k].as_py())
                made += found
                texts += [k] * len(found)
            columns = zip(*made, strict=True) if made else [[]] * 5
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(texts, pa.int64())),
                    *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ],
                names=["id", "start", "end", "n_words", "class_key", "removed"],
            )

    def grown(places: bytes, hits: list[dict]) -> list[tuple]:
        steps = np.frombuffer(places, "<i4").reshape(-1, 4)
        first, start = np.cumsum(steps[:, 0]), np.cumsum(steps[:, 2])
        past, end = first + steps[:, 1], start + steps[:, 3]
        unit = np.array([h["unit"] for h in hits])
        # Units overlap by a segment: a gap of one unit leaves no word between.
        cuts = np.flatnonzero(np.diff(unit) > 2) + 1
        made = []
        for a, b in zip([0, *cuts], [*cuts, len(hits)], strict=True):
            u, v, own = unit[a], unit[b - 1], hits[a:b]
            if past[v] - first[u] >= min_words:
                key, new = min(h["key"] for h in own), any(h["new"] for h in own)
                made.append((int(start[u]), int(end[v]), int(past[v] - first[u]), key, not new))
        return made

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "places", "hits").mapInArrow(
        lean(run),
        f"id {kind}, start INT, end INT, n_words INT, class_key LONG, removed BOOLEAN",
    )


def repeated_segments(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    around: int = AROUND,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Every passage whose units are all found in other texts too.

    Columns: ``id``, ``start`` and ``end`` (code points of its first and behind its last whole
    unit; the passage itself may reach a segment further), ``n_words``, ``class_key`` (the
    smallest unit key, alike for equal passages), ``class_id`` (the smallest id of its
    class) and ``removed``: whether all its units stand in an earlier row or place, so
    that cutting it out loses no unit.

    Words are split at ASCII white space and compared in lower-case A-Z. What one text alone
    repeats is left out. NULL and short texts have no units; a repeated row repeats its
    passages. Keys alone are gathered before anything else travels, and texts are not
    compared in pairs. Stores texts' keys, the repeated ones, and passages in the shared folder.
    """
    rows = docs.select(
        F.col(id).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(text, F.lit("")).alias("t"),
    )
    placed = Stored(_placed(rows, around)).frame
    units = placed.select("row", F.posexplode("keys").alias("unit", "key"))
    ends = units.groupBy("key").agg(F.min("row").alias("least"), F.max("row").alias("last"))
    often = Stored(ends.where("least < last").select("key")).frame
    hits = Stored(units.join(often, "key")).frame
    # The first place of a key is a minimum; a key found everywhere is split in the join.
    first = Stored(hits.groupBy("key").agg(F.min(F.struct("row", "unit")).alias("first"))).frame
    marked = hits.join(first, "key").select(
        "row", "unit", "key", (F.struct("row", "unit") == F.col("first")).alias("new")
    )
    by_text = marked.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("unit", "key", "new"))).alias("hits")
    )
    passages = Stored(_grown(placed.join(by_text, "row"), min_words)).frame
    least = Stored(passages.groupBy("class_key").agg(F.min("id").alias("class_id"))).frame
    return passages.join(least, "class_key").select(
        F.col("id").alias(id), "start", "end", "n_words", "class_key", "class_id", "removed"
    )

"""Removal of repeated paragraphs by MinHash banding.

A paragraph is a line of enough words. Equal sets of word n-grams are one key from
the start; keys that collide in a band are put in one group, groups are checked pair
by pair with exact Jaccard similarity, and of each connected component of similar
paragraphs one stays. Bands are tuned so that a pair at the threshold collides with
the wanted probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.bytetext import Texts, Words, distinct_sets, mix, shingles, slices, words
from plumbline.llm.components import components
from plumbline.llm.similar import (
    SHINGLE,
    SIMILARITY,
    block_counts,
    checked,
    in_blocks,
    minima,
    set_key,
)
from plumbline.llm.storage import Stored

MIN_WORDS = 30
RECALL = 0.999
ROWS = 3

_LINE = np.zeros(256, bool)
_LINE[10] = True


def bands_for(recall: float, similarity: float, rows: int = ROWS) -> int:
    """Bands of ``rows`` values so that a pair at the threshold shares one with ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def _cut(part: Texts, min_words: int) -> tuple[Texts, np.ndarray, np.ndarray]:
    """Long lines as texts of their own, with the text and the number of each line."""
    lines = words(part, fold=False, breaks=_LINE)
    inner = words(part)
    at = np.searchsorted(lines.starts, inner.starts, side="right") - 1
    count = np.bincount(at, minlength=len(lines.starts)) if len(at) else np.zeros(len(lines.starts))
    keep = np.flatnonzero(count >= min_words)
    # Lines are numbered by the line ends before them in their text.
    ends = np.concatenate(([0], np.cumsum(part.data == 10)))
    number = ends[lines.starts] - ends[part.offsets[:-1]][lines.owner]
    starts, stops = lines.starts[keep], lines.ends[keep]
    pieces = [part.data[a:b] for a, b in zip(starts, stops, strict=True)]
    data = np.concatenate([*pieces, np.empty(0, np.uint8)])
    cut = Texts(data, np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64), 0)
    return cut, lines.owner[keep], np.stack((number[keep], starts, stops), axis=1)


def _points(part: Texts, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions in a slice as code points of their text."""
    before = np.concatenate(([0], np.cumsum((part.data & 0xC0) != 0x80)))
    return before[at] - before[part.offsets[:-1]][owner]


def _keyed(docs: DataFrame, min_words: int, shingle: int, bands: int) -> DataFrame:
    """Every paragraph of every document with its place, key, size and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                cut, owner, place = _cut(part, min_words)
                n = len(cut)
                w: Words = words(cut)
                found = distinct_sets(*shingles(w, shingle, n), n) if n else []
                values = minima(found, bands * ROWS) if n else np.empty((0, bands * ROWS), np.uint32)
                band = np.zeros((n, bands), np.uint64)
                for k in range(ROWS):
                    band = mix(band * np.uint64(3) + values[:, k::ROWS] + np.uint64(k + 1))
                band = mix(band + np.arange(bands, dtype=np.uint64)[None, :])
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(owner, pa.int64())),
                        pa.array(place[:, 0].astype(np.int32)),
                        pa.array(_points(part, owner, place[:, 1]).astype(np.int32)),
                        pa.array(_points(part, owner, place[:, 2]).astype(np.int32)),
                        pa.array([set_key(s) for s in found], pa.int64()),
                        pa.array([len(s) for s in found], pa.int32()),
                        pa.ListArray.from_arrays(
                            np.arange(n + 1, dtype=np.int32) * bands,
                            pa.array(band.ravel().view(np.int64)),
                        ),
                    ],
                    names=["id", "line", "start", "end", "key", "size", "bands"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"id {kind}, line INT, start INT, end INT, key LONG, size INT, bands ARRAY<LONG>"
    )


def _values(docs: DataFrame, wanted: DataFrame, min_words: int, shingle: int) -> DataFrame:
    """The whole n-gram sets of wanted keys, found again in one document of each."""
    lists = wanted.groupBy("id").agg(
        F.collect_list(F.struct("key", "group", "size")).alias("wanted")
    )
    # The texts are shuffled at every size, so that costs follow the input.
    rows = docs.join(lists.hint("merge"), "id").select("t", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                cut, owner, _ = _cut(part, min_words)
                n = len(cut)
                found = distinct_sets(*shingles(words(cut), shingle, n), n) if n else []
                out: list[tuple] = []
                asked = [
                    {x["key"]: x for x in batch.column(1)[part.first + k].as_py()}
                    for k in range(len(part))
                ]
                for at, values in zip(owner, found, strict=True):
                    hit = asked[at].pop(set_key(values), None)
                    if hit:
                        out.append((hit["key"], hit["group"], hit["size"], values.tobytes()))
                columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["key", "group", "size", "values"],
                )

    made = rows.mapInArrow(run, "key LONG, group LONG, size INT, values BINARY")
    return made.groupBy("group", "key").agg(
        F.first("values").alias("values"), F.first("size").alias("size")
    )


def repeated_paragraphs(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """Every paragraph that has a similar one, with its component and whether it goes.

    Columns: ``id``, ``line`` (from 0), ``start`` and ``end`` (code points, end
    exclusive), ``class_id`` (the smallest id that holds a paragraph of the component),
    ``class_key`` (the component) and ``removed``: false for one paragraph of each
    component, the first by id and line.

    A paragraph is a line with at least ``min_words`` words; two are similar if the
    Jaccard similarity of their sets of ``shingle`` words (lower-case A-Z) is at least
    ``similarity``. NULL and empty texts have no paragraphs. Repeated rows repeat their
    paragraphs; a NULL id comes last, and paragraphs whose ids are all NULL are only
    found alike if their sets are equal. Other columns are left out.
    """
    bands = bands_for(recall, similarity)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    placed = Stored(_keyed(rows, min_words, shingle, bands))
    everywhere = placed.frame
    keys = Stored(
        everywhere.groupBy("key").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("id").alias("id"),
            F.first("size").alias("size"),
            F.first("bands").alias("bands"),
        )
    ).frame
    band = keys.select(F.explode("bands").alias("band"), "key")
    # One link from each key to the smallest key of its band: a group hangs together
    # whatever its size. Bands with one key have none.
    least = Stored(
        band.groupBy("band")
        .agg(F.min("key").alias("root"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("band", "root")
    ).frame
    links = band.join(least, "band").where(F.col("key") != F.col("root")).select("key", "root").distinct()
    groups = components(links, "key", "root").select(
        F.col("id").alias("key"), F.col("root").alias("group")
    )
    wanted = Stored(keys.select("key", "id", "size").join(groups, "key")).frame
    members = in_blocks(
        _values(rows, wanted, min_words, shingle).withColumn("weight", F.lit(1).cast("long")),
        "group",
        block_counts(wanted, "group"),
    )
    found = checked(members, "group", similarity).where(F.col("b").isNotNull())
    classes = components(found).select(F.col("id").alias("key"), F.col("root").alias("class"))
    told = (
        keys.select("key", "copies", "id")
        .join(classes, "key", "left")
        .where((F.col("copies") > 1) | F.col("class").isNotNull())
        .withColumn("class", F.coalesce("class", "key"))
    )
    info = Stored(told.select("key", "class")).frame
    hit = everywhere.select("id", "line", "start", "end", "key").join(info, "key")
    # The first paragraph of a component is a minimum, not a sort of the component.
    place = F.struct(F.col("id").isNull().alias("none"), "id", "line")
    first = Stored(
        hit.groupBy("class").agg(F.min(place).alias("first"), F.min("id").alias("class_id"))
    ).frame
    twin = Window.partitionBy("class", "id", "line").orderBy("start")
    return (
        hit.join(first, "class")
        .withColumn("copy", F.row_number().over(twin))
        .select(
            F.col("id").alias(id),
            "line",
            "start",
            "end",
            "class_id",
            F.col("class").alias("class_key"),
            (~((place == F.col("first")) & (F.col("copy") == 1))).alias("removed"),
        )
    )


def without(docs: DataFrame, found: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed paragraphs' lines cut out of ``text``.

    The lines of a document are gathered by id; a removed line goes with its line end.
    """
    lines = (
        found.where("removed")
        .groupBy(F.col(id).alias("__id"))
        .agg(F.collect_set("line").alias("__lines"))
    )
    kept = F.filter(
        F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(F.col("__lines"), i)
    )
    joined = docs.join(lines, docs[id] == F.col("__id"), "left")
    return joined.withColumn(
        text, F.when(F.col("__lines").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text))
    ).drop("__id", "__lines")

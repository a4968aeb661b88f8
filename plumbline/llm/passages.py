"""Passages of words that occur more than once, wherever lines begin and end.

Every run of ``RUN`` words has one anchor, its word n-gram of ``GRAM`` words with the
smallest hash, so equal runs have equal anchors. Anchors that occur once are left
out; the runs of the others are counted by their hash. No pair of texts is compared,
so the work grows with the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.bytetext import Texts, Words, slices, spans, words
from plumbline.llm.paragraphs import _points
from plumbline.llm.storage import Stored

RUN = 50
GRAM = 25


def _anchored(part: Texts, run: int, gram: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words; first word of every run; the place of its anchor, and the anchor's hash."""
    w = words(part)
    at, hashes = spans(w, gram)
    own, n = w.owner[at], run - gram + 1
    if len(at) < n:
        none = np.empty(0, np.int64)
        return w, none, none, np.empty(0, np.uint64)
    # Runs lie inside one text: their first and last n-grams have one owner.
    whole = np.flatnonzero(own[n - 1 :] == own[: len(own) - n + 1])
    best = np.lib.stride_tricks.sliding_window_view(hashes, n).argmin(axis=1)[whole] + whole
    return w, at[whole], at[best], hashes[best]


def _anchors(docs: DataFrame, run: int, gram: int) -> DataFrame:
    """Each text of at least ``run`` words, its extent, and its distinct anchors.

    ``twice`` tells for each anchor whether it has more than one place in the text.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                w, first, place, anchor = _anchored(part, run, gram)
                owner = w.owner[first]
                texts = np.unique(owner)
                if not len(texts):
                    continue
                order = np.lexsort((place, anchor, owner))
                o, a, p = owner[order], anchor[order], place[order]
                new = np.ones(len(o), bool)
                new[1:] = (o[1:] != o[:-1]) | (a[1:] != a[:-1])
                heads = np.flatnonzero(new)
                tails = np.concatenate((heads[1:], [len(o)])) - 1
                sizes = np.searchsorted(o[heads], texts, side="right")
                cuts = np.concatenate(([0], sizes)).astype(np.int32)
                counts = np.bincount(w.owner, minlength=len(part))
                ends = np.cumsum(counts)
                start = _points(part, texts, w.starts[(ends - counts)[texts]])
                end = _points(part, texts, w.ends[ends[texts] - 1])
                rows = pa.array(texts + part.first, pa.int64())
                twice = p[tails] != p[heads]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(counts[texts].astype(np.int32)),
                        pa.array(start.astype(np.int32)),
                        pa.array(end.astype(np.int32)),
                        pa.ListArray.from_arrays(cuts, pa.array(a[heads].view(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(twice)),
                    ],
                    names=["id", "key", "n_words", "start", "end", "anchors", "twice"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        read,
        f"id {kind}, key LONG, n_words INT, start INT, end INT, "
        "anchors ARRAY<LONG>, twice ARRAY<BOOLEAN>",
    )


def _runs(rows: DataFrame, run: int, gram: int) -> DataFrame:
    """The runs with a wanted anchor: hash, text, first word, and extent in code points."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            for part in slices(batch.column(2)):
                w, first, _, anchor = _anchored(part, run, gram)
                owner = w.owner[first]
                keep = np.zeros(len(first), bool)
                edges = np.searchsorted(owner, np.arange(len(part) + 1))
                for k in range(len(part)):
                    lo, hi = edges[k], edges[k + 1]
                    wanted = np.asarray(lists[part.first + k].values).view(np.uint64)
                    keep[lo:hi] = np.isin(anchor[lo:hi], wanted)
                at, hashes = spans(w, run)
                # Both list the first words of all whole runs, in order.
                at, hashes, owner = at[keep], hashes[keep], owner[keep]
                counts = np.bincount(w.owner, minlength=len(part))
                opens = np.cumsum(counts) - counts
                rows = pa.array(owner + part.first, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array((at - opens[owner]).astype(np.int32)),
                        pa.array(_points(part, owner, w.starts[at]).astype(np.int32)),
                        pa.array(_points(part, owner, w.ends[at + run - 1]).astype(np.int32)),
                    ],
                    names=["hash", "id", "key", "at", "start", "end"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "key", "t", "wanted").mapInArrow(
        read, f"hash LONG, id {kind}, key LONG, at INT, start INT, end INT"
    )


def repeated_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", run: int = RUN, gram: int = GRAM
) -> DataFrame:
    """Every passage of ``run`` words or more that occurs more than once.

    Columns: ``id``, ``start`` and ``end`` (code points, end exclusive), ``n_words``,
    ``first_id`` (the smallest id where a run of the passage is first) and ``removed``.
    The first place of a run is that with the smallest id (NULL last; different texts of
    one id in the order of a hash), then the first in its text. A row is a longest
    sequence of overlapping runs that are all first, or all not first, at their place:
    ``removed`` is false, or true. A row that stays may overlap rows that go; every word
    of a row that goes is also at an earlier place.

    Words are separated by white space, line ends too, and compared in lower-case A-Z.
    Of equal texts each but the first is one row that goes, and the first is one row that
    stays, beside rows it shares with other, earlier texts. Other columns are left out.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t")).select(
        "id", F.xxhash64("t").alias("key"), "t"
    )
    told = Stored(_anchors(rows, run, gram)).frame
    each = told.select("key", F.explode(F.arrays_zip("anchors", "twice")).alias("z")).select(
        "key", F.col("z.anchors").alias("anchor"), "z.twice"
    )
    often = (
        each.groupBy("anchor")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.max("twice").alias("twice"))
        .where((F.col("low") != F.col("high")) | F.col("twice"))
        .select("anchor")
    )
    own = F.struct(F.col("id").isNull().alias("none"), "id")
    info = Stored(
        told.groupBy("key").agg(F.min(own)["id"].alias("id"), F.count(F.lit(1)).alias("copies"))
    ).frame
    lists = (
        each.select("key", "anchor")
        .join(often, "anchor")
        .groupBy("key")
        .agg(F.collect_set("anchor").alias("wanted"))
        .join(info.select("key", "id"), "key")
    )
    # Of equal texts one is enough, and partial results drop the others before the shuffle.
    texts = rows.select("key", "t").dropDuplicates(["key"])
    found = Stored(_runs(texts.join(lists.hint("merge"), "key"), run, gram)).frame
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "at")
    firsts = (
        found.groupBy("hash")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("hash", "first")
    )
    marked = found.join(firsts, "hash").select(
        "key",
        "at",
        "start",
        "end",
        (place != F.col("first")).alias("removed"),
        F.struct(F.col("first.none").alias("none"), F.col("first.id").alias("id")).alias("from"),
    )
    in_order = Window.partitionBy("key", "removed").orderBy("at")
    joined = (
        marked.withColumn("island", F.col("at") - F.row_number().over(in_order))
        .groupBy("key", "removed", "island")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            (F.count(F.lit(1)) + run - 1).cast("int").alias("n_words"),
            F.min("from")["id"].alias("first_id"),
        )
        .drop("island")
    )
    many = info.where("copies > 1").select("key", F.col("id").alias("first_id"))
    twin = Window.partitionBy("key", "id").orderBy("start")
    whole = (
        told.select("id", "key", "start", "end", "n_words")
        .join(many, "key")
        .withColumn("copy", F.row_number().over(twin))
        .withColumn("removed", ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("copy") == 1)))
    )
    out = [F.col("id").alias(id), "start", "end", "n_words", "first_id", "removed"]
    parts = joined.join(info, "key").where((F.col("copies") == 1) | F.col("removed"))
    return parts.select(*out).union(whole.select(*out))

"""Jaccard join of documents on word n-grams by chosen paths.

Documents with the same set of n-grams are one class from the start. Sets are split
recursively: at a node, every set follows the tokens of its MinHash embedding that
the node's own hash samples, so similar sets go on together along the tokens they
share. Nodes with few sets are compared by brute force, larger ones are split on, and
what is still large at the last level is compared in pairs of blocks. Runs are
repeated until similar pairs survive in one of them with the wanted probability.
The comparison of embeddings only groups candidates; every pair inside a group of
candidates is then checked on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bytetext import distinct_sets, mix, shingles, slices, words
from plumbline.llm.components import components
from plumbline.llm.similar import (
    SHINGLE,
    SIMILARITY,
    Forest,
    block_counts,
    checked,
    in_blocks,
    minima,
    set_key,
)
from plumbline.llm.storage import Stored
from plumbline.llm.workers import lean

#: Values in an embedding. Pairs that agree in fewer than CLOSE of them are no candidates:
#: a pair at the threshold does so with a probability of about one in a million.
EMBEDDED = 64
CLOSE = 35
#: Expected tokens that a set follows at a node.
FOLLOWED = 2.0
LEAF = 64
LEVELS = 3
RECALL = 0.999
NODE_BLOCK = 2048


def runs_for(recall: float, similarity: float, levels: int) -> int:
    """Runs after which a pair at the threshold shares a last node with this probability.

    Of the tokens a set follows, a similar one follows ``similarity``; that is a branching
    process, which dies out within ``levels`` with the probability worked out here.
    """
    lost = 0.0
    for _ in range(levels):
        lost = math.exp(FOLLOWED * similarity * (lost - 1))
    return math.ceil(math.log(1 - recall) / math.log(lost))


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """id, key of its n-gram set, size and embedding, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                n = len(part)
                found = distinct_sets(*shingles(words(part), shingle, n), n)
                full = [s for s in found if len(s)]
                rows = iter(minima(full, EMBEDDED) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, n),
                        pa.array([set_key(s) for s in found], pa.int64()),
                        pa.array([len(s) for s in found], pa.int32()),
                        pa.array(
                            [next(rows).tobytes() if len(s) else b"" for s in found], pa.binary()
                        ),
                    ],
                    names=["id", "key", "size", "embedding"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(lean(run), f"id {kind}, key LONG, size INT, embedding BINARY")


def _follow(nodes: DataFrame, level: int) -> DataFrame:
    """Children of nodes: rows (node, key, embedding) become rows (node, key)."""
    limit = np.uint64(int(FOLLOWED / EMBEDDED * 2**64))
    coordinate = mix(np.arange(1, EMBEDDED + 1, dtype=np.uint64) * np.uint64(level * 2 + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                node = np.asarray(some.column(0)).view(np.uint64)
                key = np.asarray(some.column(1))
                values = np.stack([np.frombuffer(v.as_py(), np.uint32) for v in some.column(2)])
                child = mix(mix(node)[:, None] ^ mix(values + coordinate[None, :]))
                row, token = np.nonzero(mix(child) < limit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child[row, token].view(np.int64)), pa.array(key[row])],
                    names=["node", "key"],
                )

    return nodes.select("node", "key", "embedding").mapInArrow(lean(run), "node LONG, key LONG")


def _near_pairs(rows: DataFrame, by: list[str], blocks: bool) -> DataFrame:
    """Links that connect sets with close embeddings inside each group."""

    def run(table: pa.Table) -> pa.Table:
        keys = np.asarray(table.column("key"))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        values = np.stack([np.frombuffer(v.as_py(), np.uint32) for v in table.column("embedding")])
        values = values[order]
        left = right = np.arange(len(keys))
        if blocks:
            own = np.asarray(table.column("own"))[order]
            left = np.flatnonzero(own == table.column("i")[0].as_py())
            right = np.flatnonzero(own == table.column("j")[0].as_py())
        trees = Forest(len(keys))
        for x in left:
            near = right[(values[right] == values[x]).sum(axis=1) >= CLOSE]
            for y in near:
                if y != x:
                    trees.join(int(x), int(y))
        a, b = [keys[x] for x, _ in trees.links], [keys[y] for _, y in trees.links]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy(*by).applyInArrow(run, "a LONG, b LONG")


def candidate_links(sets: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Stored links (a, b) that connect all candidate sets; ``sets`` is stored."""
    runs = range(1, runs_for(recall, similarity, LEVELS) + 1)
    roots = F.array(*[F.xxhash64(F.lit(run)) for run in runs])
    start = sets.select(F.explode(roots).alias("node"), "key", "embedding")
    level = Stored(_follow(start, 1))
    embedded = sets.select("key", "embedding")
    parts, leaves = [], []
    for depth in range(1, LEVELS + 1):
        nodes = level.frame.distinct()
        # Both sides of the join are plain stored tables, so a hot node can be split.
        counted = Stored(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        sized = level.frame.join(counted.frame, "node")
        leaves.append(
            sized.where(F.col("n") <= LEAF)
            .groupBy("node")
            .agg(F.array_sort(F.collect_set("key")).alias("keys"))
            .select("keys")
        )
        large = sized.where(F.col("n") > LEAF)
        if depth < LEVELS:
            level = Stored(_follow(large.distinct().join(embedded, "key"), depth + 1))
    sizes = counted.frame.where(F.col("n") > LEAF).select(
        "node", F.ceil(F.col("n") / NODE_BLOCK).cast("int").alias("blocks")
    )
    rows = in_blocks(level.frame.distinct(), "node", sizes).join(embedded, "key")
    parts.append(_near_pairs(rows, ["node", "i", "j"], blocks=True))
    # Similar sets meet in many nodes: the same group is compared once.
    groups = leaves[0]
    for more in leaves[1:]:
        groups = groups.union(more)
    group = groups.distinct().select(F.xxhash64("keys").alias("group"), F.explode("keys").alias("key"))
    parts.append(_near_pairs(group.join(embedded, "key"), ["group"], blocks=False))
    return Stored(parts[0].union(parts[1]).distinct()).frame


def _values(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """The whole set behind each wanted key: ``docs`` has id and t, ``wanted`` id and key."""
    # The texts are shuffled at every size, so that costs follow the input.
    rows = docs.join(wanted.hint("merge"), "id").select("key", "t", "size", "weight", "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                n = len(part)
                found = distinct_sets(*shingles(words(part), shingle, n), n)
                keys = batch.column(0).slice(part.first, n)
                # An id may be repeated with another text.
                same = [k for k, s in enumerate(found) if set_key(s) == keys[k].as_py()]
                rest = [batch.column(c).slice(part.first, n).take(pa.array(same, pa.int64())) for c in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(same, pa.int64())),
                        pa.array([found[k].tobytes() for k in same], pa.binary()),
                        *rest,
                    ],
                    names=["key", "values", "size", "weight", "group"],
                )

    made = rows.mapInArrow(lean(run), "key LONG, values BINARY, size INT, weight LONG, group LONG")
    return made.groupBy("group", "key").agg(
        F.first("values").alias("values"), F.first("size").alias("size"), F.first("weight").alias("weight")
    )


def similar_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """``id``, ``class_id`` and ``n_links`` of every document.

    Two documents are linked if the Jaccard similarity of their sets of ``shingle``
    words (lower-case A-Z, split at ASCII white space; a shorter text is one n-gram) is
    at least ``similarity``. ``class_id`` is the smallest id of the connected component,
    ``n_links`` the number of other documents linked to it, copies counted one by one.
    A text without words, or NULL, is linked to none and its own class. Repeated rows
    are documents of their own with the same id; other columns are left out.

    Copies travel as one class; only candidate groups are compared pair by pair, and
    their pairs are counted where they are found, never written out. Stores embeddings,
    levels and links in the shared folder and runs a job for each.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    placed = Stored(_sets(rows, shingle))
    sets = Stored(
        placed.frame.where("size > 0")
        .groupBy("key")
        .agg(
            F.min("id").alias("id"),
            F.count(F.lit(1)).alias("weight"),
            F.first("size").alias("size"),
            F.first("embedding").alias("embedding"),
        )
    ).frame
    groups = components(candidate_links(sets, similarity, recall)).select(
        F.col("id").alias("key"), F.col("root").alias("group")
    )
    wanted = Stored(sets.drop("embedding").join(groups, "key"))
    blocks = block_counts(wanted.frame, "group")
    members = in_blocks(_values(rows, wanted.frame, shingle), "group", blocks)
    found = Stored(checked(members, "group", similarity)).frame
    linked = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("near"))
    classes = components(found.where(F.col("b").isNotNull())).select(
        F.col("id").alias("key"), F.col("root").alias("class")
    )
    told = sets.drop("embedding").join(linked, "key", "left").join(classes, "key", "left")
    told = told.withColumn("class", F.coalesce("class", "key")).where(
        (F.col("weight") > 1) | F.col("near").isNotNull()
    )
    least = told.groupBy("class").agg(F.min("id").alias("class_id"))
    info = Stored(
        told.join(least, "class").select(
            "key",
            "class_id",
            (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    ).frame
    lone = F.col("size") == 0
    return (
        placed.frame.select("id", "key", "size")
        .join(info, "key", "left")
        .select(
            F.col("id").alias(id),
            F.when(lone, F.col("id")).otherwise(F.coalesce("class_id", "id")).alias("class_id"),
            F.when(lone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        )
    )

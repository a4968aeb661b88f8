"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Each byte of a text opens six triplets inside a window of five bytes. They are
hashed into buckets; a bucket is encoded by the quartile of its count among all
buckets of the text, and the length by its logarithm. Two digests are compared by
a bounded sum of quartile differences, so similar texts stay close wherever an
edit falls.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.bytetext import slices
from plumbline.llm.storage import Stored

BUCKETS = 256
# Byte offsets of the triplets that start at a byte: pairs out of the next four.
_TRIPLETS = ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4))
_HASH = np.random.default_rng(1999).integers(0, BUCKETS, (3, 6, 256)).astype(np.uint8)
_CUTS = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
_SLICE = 1 << 18


def digests(column: pa.Array) -> list[np.ndarray]:
    """One digest per text: length code, then a quartile from 0 to 3 per bucket."""
    found = []
    for part in slices(column, _SLICE):
        data, n = part.data, len(part)
        counts = np.zeros(n * BUCKETS, np.int64)
        base = np.repeat(np.arange(n) * BUCKETS, np.diff(part.offsets))
        for k, (second, third) in enumerate(_TRIPLETS):
            m = len(data) - third
            if m <= 0:
                continue
            bucket = _HASH[0, k][data[:m]]
            bucket ^= _HASH[1, k][data[second : second + m]]
            bucket ^= _HASH[2, k][data[third:]]
            at = base[:m] + bucket
            counts += np.bincount(at, minlength=len(counts))
            # A triplet that runs over the end of its text counts nowhere.
            over = (part.offsets[1:-1, None] - np.arange(1, third + 1)).ravel()
            over = np.unique(over[(over >= 0) & (over < m)])
            over = over[base[over] != base[over + third]]
            counts -= np.bincount(at[over], minlength=len(counts))
        counts = counts.reshape(n, BUCKETS)
        ranked = np.partition(counts, _CUTS, axis=1)[:, _CUTS]
        body = (counts[:, :, None] > ranked[:, None, :]).sum(axis=2, dtype=np.uint8)
        length = np.rint(16 * np.log2(1 + np.diff(part.offsets))).astype(np.int64)
        head = np.stack((length >> 8, length & 255), axis=1).astype(np.uint8)
        found.extend(np.concatenate((head, body), axis=1))
    return found


def text_of(digest: np.ndarray) -> str:
    """Hexadecimal form: four digits of length, then two buckets to a digit."""
    body = digest[2:]
    return digest[:2].tobytes().hex() + np.packbits(
        np.stack(((body >> 1) & 1, body & 1), axis=1).ravel()
    ).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: 1 for equal digests, about 0 for what unrelated counts would give.

    The difference adds up quartile distances, a step over the whole range counting
    double, and up to a sixteenth of the total for lengths; it is cut off at what two
    independent digests differ by on average.
    """
    steps = np.abs(a[2:].astype(np.int64) - b[2:])
    apart = steps.sum() + 3 * (steps == 3).sum()
    length = abs((int(a[0]) << 8 | int(a[1])) - (int(b[0]) << 8 | int(b[1])))
    bound = BUCKETS * (20 / 16 + 3 * 2 / 16)
    return max(0.0, 1.0 - (apart + min(length, 64) / 64 * bound / 16) / bound)


def likeness_of(a: str, b: str) -> float:
    """:func:`likeness` of two digests in hexadecimal form."""

    def parse(s: str) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(s[4:]), np.uint8)).reshape(-1, 2)
        return np.concatenate((list(bytes.fromhex(s[:4])), bits[:, 0] * 2 + bits[:, 1]))

    return likeness(parse(a).astype(np.uint8), parse(b).astype(np.uint8))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fingerprint`` of every whole text; equal texts have equal ones.

    NULL is the empty text, whose digest has only zeros. One row per row that goes in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [text_of(d) for d in digests(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.string())], names=["id", "fingerprint"]
            )

    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint STRING").withColumnRenamed("id", id)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_RESULT = pa.schema(
    [
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_RESULT_SQL = (
    "n_chars LONG, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
    "near_edited DOUBLE, near_next DOUBLE"
)


def _compared(texts: list[str]) -> list[pa.Array]:
    """The result columns for all texts but the last, each followed by the next."""
    edits = [edited(t, f) for t, f in zip(texts, texts[1:], strict=False)]
    chain = digests(pa.array(texts, pa.large_string()))
    made = digests(pa.array(edits, pa.large_string()))
    own = chain[:-1]
    columns = (
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(e.encode()).hexdigest() for e in edits],
        [text_of(d) for d in own],
        [text_of(d) for d in made],
        [likeness(a, b) for a, b in zip(own, made, strict=True)],
        [likeness(a, b) for a, b in zip(own, chain[1:], strict=True)],
    )
    return [pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)]


def edit_check(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's digest against that of its edited text and that of the next text.

    The next text has the next smaller ``id``; after the last comes the first. Rows of
    one id are taken in the order of their text's hash, a NULL id comes last, a NULL
    text is empty. Result: one row per row, with ``id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``.

    Texts are shuffled once, by ranges of the id, so neighbours meet in one task; only
    the first and the last text of each range are joined across ranges. Runs one job
    that stores the ranges' results.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    ranges = (
        rows.repartitionByRange(F.desc_nulls_last("id"))
        .sortWithinPartitions(F.desc_nulls_last("id"), F.xxhash64("t"), "t")
        .withColumn("part", F.spark_partition_id())
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        part = None

        def out(ids, result, edge, texts):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [
                    ids,
                    *(result or [pa.nulls(n, f.type) for f in _RESULT]),
                    pa.array([edge] * n, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([part] * n, pa.int32()),
                ],
                names=["id", *_RESULT.names, "edge", "t", "part"],
            )

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            if not texts:
                continue
            part = batch.column(2)[0].as_py()
            if held is None:
                yield out(ids.slice(0, 1), None, "first", texts[:1])
                chain, names = texts, ids
            else:
                chain = [held[1], *texts]
                names = pa.concat_arrays([held[0], ids])
            at, size = 0, 0
            for i in range(len(chain) - 1):
                size += len(chain[i])
                if size > 1 << 20 or i == len(chain) - 2:
                    result = _compared(chain[at : i + 2])
                    yield out(names.slice(at, i + 1 - at), result, None, [None] * (i + 1 - at))
                    at, size = i + 1, 0
            held = (names.slice(len(chain) - 1, 1), chain[-1])
        if held is not None:
            yield out(held[0], None, "last", [held[1]])

    stored = Stored(
        ranges.mapInArrow(run, f"id {kind}, {_RESULT_SQL}, edge STRING, t STRING, part INT")
    ).frame
    edges = stored.where(F.col("edge").isNotNull())
    first = edges.where(F.col("edge") == "first").select(
        F.col("part").alias("next_part"), F.col("t").alias("next_t")
    )
    # One row per range: the window runs over as many rows as the shuffle has partitions.
    parts = first.select(F.col("next_part").alias("part"))
    order = Window.orderBy("part")
    whole = Window.partitionBy()
    following = parts.select(
        "part", F.coalesce(F.lead("part").over(order), F.min("part").over(whole)).alias("next_part")
    )
    last = edges.where(F.col("edge") == "last").select("id", "t", "part")
    stitched = last.join(following, "part").join(first, "next_part").select("id", "t", "next_t")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = [batch.column(1)[i].as_py(), batch.column(2)[i].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), *_compared(pair)],
                    names=["id", *_RESULT.names],
                )

    return (
        stored.where(F.col("edge").isNull())
        .select("id", *_RESULT.names)
        .union(stitched.mapInArrow(stitch, f"id {kind}, {_RESULT_SQL}"))
        .withColumnRenamed("id", id)
    )

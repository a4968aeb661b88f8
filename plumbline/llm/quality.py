"""Quality classifier: naive Bayes support vectors.

Features are indicators of word n-grams and of word-shape n-grams, hashed into a
fixed number of buckets. They are scaled by the classes' log-count ratios, and a
linear model with hinge loss is fitted to them by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bytetext import Texts, mix, slices, words

BUCKETS = 1 << 18
SAMPLE_ROWS = 6_000
COST = 0.1
EPOCHS = 12
_SLICE = 1 << 19

# Kinds of bytes, for shapes: 1 lower case or beyond ASCII, 2 upper case, 3 digit, 4 other.
_KIND = np.full(256, 4, np.uint8)
_KIND[97:123] = _KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3


def features(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs (text, bucket) of a slice.

    N-grams of one and two words, and of one to three word shapes: the kinds of the
    first, second and last byte, the last byte itself if it is a sign, the length in
    steps, and whether the word repeats one of the two before it.
    """
    w = words(part, fold=False)
    h, owner = w.hashes, w.owner
    if len(h) == 0:
        none = np.empty(0, np.int64)
        return none, none
    first, last = part.data[w.starts], part.data[w.ends - 1]
    second = part.data[np.minimum(w.starts + 1, w.ends - 1)]
    sign = np.where(_KIND[last] == 4, last, 0).astype(np.uint64)
    length = np.minimum(np.log2(w.ends - w.starts) * 1.5, 15).astype(np.uint64)
    again = np.zeros(len(h), np.uint64)
    for back in (2, 1):
        same = (h[back:] == h[:-back]) & (owner[back:] == owner[:-back])
        again[back:][same] = back
    shape = sign
    for more in (_KIND[first], _KIND[second], _KIND[last], length, again):
        shape = shape * np.uint64(16) + more
    shape = mix(shape)
    found = []

    def add(values: np.ndarray, at: np.ndarray, tag: int) -> None:
        bucket = mix(values + np.uint64(tag)) % np.uint64(BUCKETS)
        found.append(at * BUCKETS + bucket.astype(np.int64))

    add(h, owner, 1)
    add(shape, owner, 3)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    add(mix(h[pair] * np.uint64(3) + h[pair + 1]), owner[pair], 2)
    two = mix(shape[:-1] * np.uint64(3) + shape[1:])
    add(two[pair], owner[pair], 4)
    triple = np.flatnonzero(owner[2:] == owner[:-2])
    add(mix(two[triple] * np.uint64(3) + shape[triple + 2]), owner[triple], 5)
    both = np.unique(np.concatenate(found))
    return both // BUCKETS, both % BUCKETS


@dataclass(frozen=True)
class Model:
    """Weight per bucket with the ratio multiplied in, and the calibration of margins."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, part: Texts) -> np.ndarray:
        at, bucket = features(part)
        n = len(part)
        size = np.bincount(at, minlength=n)
        margin = np.bincount(at, self.weights[bucket], minlength=n) / np.sqrt(np.maximum(size, 1))
        z = self.slope * (margin + self.bias) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log of each bucket's share in class 1 over its share in class -1, smoothed by 1."""
    counts = []
    for label in (1, -1):
        own = [r for r, v in zip(rows, y, strict=True) if v == label]
        c = 1.0 + np.bincount(np.concatenate([*own, np.empty(0, np.int64)]), minlength=BUCKETS)
        counts.append(np.log(c / (len(own) + 2)))
    return counts[0] - counts[1]


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss, both classes with equal total cost."""
    x = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norm = np.array([v @ v + 1 for v in x])
    share = {label: max((y == label).mean(), 1e-9) for label in (1, -1)}
    upper = np.array([COST / (2 * share[v]) for v in y])
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * (w[rows[i]] @ x[i] + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * x[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w * ratio, bias


def _margins(rows: list[np.ndarray], w: np.ndarray, bias: float) -> np.ndarray:
    return np.array([w[r].sum() / np.sqrt(max(len(r), 1)) + bias for r in rows])


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton steps."""
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, r = p * (1 - p) + 1e-6, p - target
        g = np.array([r @ margin + 1e-3 * (a - 1), r.sum()])
        hess = np.array([[d @ margin**2 + 1e-3, d @ margin], [d @ margin, d.sum()]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on rows of distinct buckets and 0/1 labels; margins are calibrated on a fifth.

    With one class only, or no rows, every text scores that class's smoothed share.
    """
    y = np.where(labels > 0, 1, -1)
    if len(set(y)) < 2:
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return Model(np.zeros(BUCKETS), 0.0, 1.0, float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 5 == 4
    slope, shift = 1.0, 0.0
    if len(set(y[held])) == 2 and len(set(y[~held])) == 2:
        rest = [r for r, h in zip(rows, held, strict=True) if not h]
        apart = [r for r, h in zip(rows, held, strict=True) if h]
        w, bias = _descend(rest, y[~held], _ratio(rest, y[~held]))
        slope, shift = _calibrate(_margins(apart, w, bias), y[held])
    w, bias = _descend(rows, y, _ratio(rows, y))
    return Model(w, bias, slope, shift)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on at most ``sample_rows`` labelled documents, chosen by a hash of their id.

    ``labels`` has ``id`` and a 0/1 ``label``; rows with a NULL are left out, of several
    labels of one id the largest holds, of several texts the one first by hash. Ids and labels of the sample go to all tasks;
    tasks send back the sample's buckets, on which the driver runs the descent.
    """
    spark = docs.sparkSession
    picked = (
        labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y"))
        .dropna()
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id", F.lit(11)), "id")
        .limit(sample_rows)
    )
    sample = spark.createDataFrame(picked.toArrow(), picked.schema)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t")).join(
        F.broadcast(sample), "id"
    )
    # One text of each id, so that the sample stays bounded whatever is repeated.
    rows = (
        rows.groupBy("id", "y")
        .agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("first"))
        .select(F.xxhash64("id", F.lit(11)).alias("place"), "first.t", "y")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1), _SLICE):
                at, bucket = features(part)
                ends = np.searchsorted(at, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        batch.column(2).slice(part.first, len(part)),
                        pa.ListArray.from_arrays(
                            ends.astype(np.int32), pa.array(bucket.astype(np.int32))
                        ),
                    ],
                    names=["place", "y", "bucket"],
                )

    table = rows.mapInArrow(run, "place LONG, y INT, bucket ARRAY<INT>").toArrow()
    if table.num_rows == 0:
        return fit([], np.empty(0, int))
    # Rows arrive in any order: one by hash of the id and by content makes a fit repeat.
    found = [np.asarray(b.values, np.int64) for b in table.column("bucket")]
    place = np.asarray(table.column("place"))
    order = sorted(range(len(found)), key=lambda i: (place[i], found[i].tobytes()))
    y = np.asarray(table.column("y"))
    return fit([found[i] for i in order], y[order])


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep`` and ``score``, from 0 to 1 and higher for class 1, of whole texts.

    NULL and texts without words get what a text without features gets. One row per
    row that goes in. The model travels as a broadcast of fixed size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                sent.value.scores(p)
                for p in slices(batch.column(batch.num_columns - 1), _SLICE)
            ]
            scores = np.concatenate([*made, np.empty(0)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "score"],
            )

    rows = docs.select(*keep, F.coalesce(text, F.lit("")).alias("__text"))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(run, ", ".join([*kinds, "score DOUBLE"]))

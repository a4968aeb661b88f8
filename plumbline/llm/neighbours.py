"""Nearest neighbours by inner product with cross-polytope hashing and multiprobe.

Each vector gets one more component that makes its norm that of the longest vector in
its space, so that the largest inner product with a query becomes the smallest angle.
A space holds the vectors of one dimension whose norms are within a factor of two. The
unit vectors are turned by pseudo-rotations (three rounds of random signs and a fast
Hadamard transform) and named by the nearest signed axis; as many such names are put
together as the size of the space asks for. A query visits the buckets of each table
in the order of its own scores for their axes.

How many buckets a query visits is fitted: for a bounded sample of queries the exact
neighbours are found by a scan of all vectors, and the number is the one that reaches
them in the wanted share. Every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.bytetext import mix
from plumbline.llm.storage import Stored

TABLES = 2
#: Rows that a bucket has on average, at most.
BUCKET_ROWS = 512
#: Sample of queries for fitting, and the share of their neighbours to be reached.
SAMPLE_QUERIES = 128
RECALL = 0.96
#: A query that would have to visit more buckets than this visits all.
MAX_PROBES = 4096
#: Buckets are put together to about so many bytes of vectors; larger ones are cut.
BLOCK_BYTES = 1 << 23
#: Queries that meet a block in one task, and that are compared with it at once.
BLOCK_QUERIES = 1 << 12
CHUNK = 256
_SEED = 1618


@dataclass(frozen=True)
class Space:
    """Vectors of one dimension with norms over ``low``, up to ``top``."""

    dim: int
    low: float
    top: float
    rows: int
    shards: int
    #: Axes per name; a bucket is one signed axis of each.
    axes: tuple[int, ...]
    probes: int | None = None

    @property
    def size(self) -> int:
        return 1 << int(self.dim).bit_length()


def _axes(rows: int, dim: int) -> tuple[int, ...]:
    """One name over all axes, then as many as the rows need, the last over some axes."""
    size = 1 << int(dim).bit_length()
    wanted, axes = rows / BUCKET_ROWS, [size]
    while (buckets := np.prod([2.0 * a for a in axes])) < wanted:
        axes.append(int(min(size, max(2, np.ceil(wanted / buckets / 2)))))
    return tuple(axes)


@lru_cache(maxsize=64)
def _signs(table: int, level: int, size: int) -> np.ndarray:
    return np.random.default_rng([_SEED, table, level, size]).choice([-1.0, 1.0], (3, size))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), n // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack((a + b, a - b), axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def _axis_scores(points: np.ndarray, space: Space, table: int) -> list[np.ndarray]:
    """For each name the products of the turned points with all signed axes."""
    made = []
    for level, axes in enumerate(space.axes):
        turned = points
        for signs in _signs(table, level, space.size):
            turned = _hadamard(turned * signs)
        turned = turned[:, :axes]
        made.append(np.concatenate((turned, -turned), axis=1))
    return made


def _completed(vectors: np.ndarray, space: Space) -> np.ndarray:
    """Unit vectors with a component that stands for what the norm lacks."""
    points = np.zeros((len(vectors), space.size))
    points[:, : space.dim] = vectors / space.top
    points[:, space.dim] = np.sqrt(np.maximum(0, 1 - (points[:, : space.dim] ** 2).sum(axis=1)))
    return points


def _directions(queries: np.ndarray, space: Space) -> np.ndarray:
    points = np.zeros((len(queries), space.size))
    largest = np.abs(queries).max(axis=1, keepdims=True)
    scaled = queries / largest
    points[:, : space.dim] = scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))
    return points


def codes_of(vectors: np.ndarray, space: Space, table: int) -> np.ndarray:
    """The bucket of each vector: its nearest signed axes, as one number."""
    code = np.zeros(len(vectors), np.int64)
    for scores in _axis_scores(_completed(vectors, space), space, table):
        code = code * scores.shape[1] + scores.argmax(axis=1)
    return code


def probed(queries: np.ndarray, space: Space, table: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` best buckets of each query, best first, and their scores."""
    codes, sums = np.zeros((len(queries), 1), np.int64), np.zeros((len(queries), 1))
    for scores in _axis_scores(_directions(queries, space), space, table):
        best = np.argsort(-scores, axis=1, kind="stable")[:, :most]
        value = np.take_along_axis(scores, best, 1)
        codes = (codes[:, :, None] * scores.shape[1] + best[:, None, :]).reshape(len(queries), -1)
        sums = (sums[:, :, None] + value[:, None, :]).reshape(len(queries), -1)
        order = np.argsort(-sums, axis=1, kind="stable")[:, :most]
        codes, sums = (np.take_along_axis(x, order, 1) for x in (codes, sums))
    return codes, sums


def _bucket_scores(directions: np.ndarray, codes: np.ndarray, space: Space, table: int) -> np.ndarray:
    """Each query's score for one bucket."""
    total = np.zeros(len(codes))
    scores = _axis_scores(directions, space, table)
    for s in reversed(scores):
        codes, axis = codes // s.shape[1], codes % s.shape[1]
        total += s[np.arange(len(axis)), axis]
    return total


def _shard(codes: np.ndarray, space: Space) -> np.ndarray:
    return (mix(codes.astype(np.uint64)) % np.uint64(space.shards)).astype(np.int64)


def _spaces_of(dims: np.ndarray, norms: np.ndarray, spaces: list[Space]) -> np.ndarray:
    found = np.full(len(dims), -1)
    for k, s in enumerate(spaces):
        found[(dims == s.dim) & (norms > s.low) & (norms <= s.top)] = k
    return found


def _matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    """Packed vectors of one dimension as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _flat(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten())


class _Side:
    """Rows ``k1, k2, dim, norm, ids, v`` by space: their buckets, grouped by unit.

    A unit is a shard of a table of a space, as one number.
    """

    def __init__(self, spaces: list[Space], kind: str, queries: bool, tables: int, everywhere: bool):
        self.spaces, self.kind, self.queries = spaces, kind, queries
        self.tables, self.everywhere = tables, everywhere

    def units(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(rows, units, buckets): a query has a row, with packed buckets, per unit that it
        visits, and no buckets where it visits all of them."""
        dims, norms = np.asarray(batch.column("dim")), np.asarray(batch.column("norm"))
        held = _spaces_of(dims, norms, self.spaces)
        for k, space in enumerate(self.spaces):
            # A query visits every space of its dimension, whatever its own norm.
            rows = np.flatnonzero(dims == space.dim if self.queries else held == k)
            if len(rows) == 0:
                continue
            vectors = _matrix(batch.column("v").take(pa.array(rows)), space.dim, self.kind)
            for table in range(self.tables):
                base = (k * TABLES + table) << 32
                if not self.queries:
                    codes = codes_of(vectors, space, table)
                    yield rows, base + _shard(codes, space), [c.tobytes() for c in codes]
                elif space.probes is None or self.everywhere:
                    if table == 0:  # One table holds them all.
                        n = space.shards
                        units = base + np.tile(np.arange(n), len(rows))
                        yield np.repeat(rows, n), units, [b""] * len(units)
                else:
                    yield self._visits(rows, vectors, space, table, base)

    def _visits(self, rows, vectors, space, table, base) -> tuple:
        codes, _ = probed(vectors, space, table, space.probes)
        owner = np.repeat(np.arange(len(rows)), codes.shape[1])
        codes = codes.ravel()
        shard = _shard(codes, space)
        order = np.lexsort((codes, shard, owner))
        owner, codes, shard = owner[order], codes[order], shard[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (shard[1:] != shard[:-1])
        at = np.flatnonzero(new)
        packed = [x.tobytes() for x in np.split(codes, at[1:])]
        return rows[owner[at]], base + shard[at], packed


_ROW = (
    "unit LONG, kind INT, k1 LONG, k2 LONG, codes BINARY, ids ARRAY<LONG>, dim INT, v BINARY"
)


def _placed(rows: DataFrame, side: _Side) -> DataFrame:
    """A row for each unit that a row belongs to or visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Small parts, since a query may be in many units.
            for at in range(0, batch.num_rows, CHUNK):
                small = batch.slice(at, CHUNK)
                for index, units, codes in side.units(small):
                    took = small.take(pa.array(index))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(units, pa.int64()),
                            pa.array(np.full(len(units), int(side.queries), np.int32)),
                            took.column("k1"),
                            took.column("k2"),
                            pa.array(codes, pa.binary()),
                            took.column("ids"),
                            took.column("dim"),
                            took.column("v"),
                        ],
                        names=["unit", "kind", "k1", "k2", "codes", "ids", "dim", "v"],
                    )

    return rows.mapInArrow(run, _ROW)


def _weighed(rows: DataFrame, side: _Side, out: str) -> DataFrame:
    """Rows (queries) or bytes (vectors) of each unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                small = batch.slice(at, CHUNK)
                size = np.array([1 if side.queries else len(v) for v in small.column("v").to_pylist()])
                for index, units, _ in side.units(small):
                    unit, inverse = np.unique(units, return_inverse=True)
                    weight = np.bincount(inverse, size[index]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(unit), pa.array(weight)], names=["unit", "w"]
                    )

    return rows.mapInArrow(run, "unit LONG, w LONG").groupBy("unit").agg(F.sum("w").alias(out))


def _best(scores: np.ndarray, owner: np.ndarray, slack: np.ndarray, k: int) -> np.ndarray:
    """Pairs whose score is among the ``k`` best of their owner, near ties included."""
    order = np.lexsort((-scores, owner))
    first = np.searchsorted(owner[order], owner[order], side="left")
    last = np.minimum(first + k, np.searchsorted(owner[order], owner[order], side="right")) - 1
    kth = scores[order][last]
    return order[scores[order] >= kth - slack[order]]


class _Block:
    """Vectors of a block by bucket."""

    def __init__(self, parts: list[pa.RecordBatch], kind: str):
        table = pa.Table.from_batches(parts).combine_chunks()
        self.dim = table.column("dim")[0].as_py()
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int64)
        order = np.argsort(codes, kind="stable")
        took = table.take(pa.array(order)).combine_chunks()
        self.k1, self.k2 = np.asarray(took.column("k1")), np.asarray(took.column("k2"))
        self.ids = took.column("ids").combine_chunks()
        self.first = np.array([x[0] for x in self.ids.to_pylist()], np.int64)
        self.vectors = _matrix(took.column("v"), self.dim, kind)
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.codes, starts = np.unique(codes[order], return_index=True)
        self.starts = np.append(starts, len(codes))

    def answer(self, batch: pa.RecordBatch, kind: str, k: int) -> pa.RecordBatch:
        """The ``k`` best of the block for each query of a part."""
        queries = _matrix(batch.column("v"), self.dim, kind)
        norms = np.sqrt((queries**2).sum(axis=1))
        lists = [np.frombuffer(c, np.int64) if c else self.codes for c in batch.column("codes").to_pylist()]
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        wanted = np.concatenate(lists)
        bucket = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        there = self.codes[bucket] == wanted
        owner, bucket = owner[there], bucket[there]
        order = np.argsort(bucket, kind="stable")
        owner, bucket = owner[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(len(self.codes) + 1))
        left, right, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        for b in np.unique(bucket):
            who = owner[cuts[b] : cuts[b + 1]]
            lo, hi = self.starts[b], self.starts[b + 1]
            product = queries[who] @ self.vectors[lo:hi].T
            near = np.ones(product.shape, bool)
            if hi - lo > k:
                kth = np.partition(product, hi - lo - k, axis=1)[:, hi - lo - k]
                slack = 1e-12 * norms[who] * self.norms[lo:hi].max()
                near = product >= (kth - slack)[:, None]
            i, j = np.nonzero(near)
            left.append(who[i])
            right.append(j + lo)
            scores.append(product[i, j])
        i, j, product = np.concatenate(left), np.concatenate(right), np.concatenate(scores)
        kept = _best(product, i, 1e-12 * norms[i] * self.norms[j], k)
        i, j = i[kept], j[kept]
        # The same sum for a pair wherever it is met.
        exact = np.empty(len(i))
        for at in range(0, len(i), 1 << 14):
            part = slice(at, at + (1 << 14))
            exact[part] = (queries[i[part]] * self.vectors[j[part]]).sum(axis=1)
        order = np.lexsort((self.first[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
        i, j, exact = i[place < k], j[place < k], exact[place < k]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("k1").take(pa.array(i)),
                batch.column("k2").take(pa.array(i)),
                pa.array(self.k1[j]),
                pa.array(self.k2[j]),
                pa.array(exact),
                self.ids.take(pa.array(j)),
            ],
            names=["k1", "k2", "c1", "c2", "score", "ids"],
        )


_FOUND = "k1 LONG, k2 LONG, c1 LONG, c2 LONG, score DOUBLE, ids ARRAY<LONG>"


def _met(index: DataFrame, queries: DataFrame, sides: tuple[_Side, _Side], k: int) -> DataFrame:
    """The best pairs of every unit that queries visit.

    A unit is cut into blocks of vectors and blocks of queries, so a bucket of any size
    is spread over tasks; in a task the vectors of a block come first and queries stream
    past them.
    """
    kind = sides[0].kind
    sizes = Stored(
        _weighed(index, sides[0], "bytes").join(_weighed(queries, sides[1], "queries"), "unit")
    ).frame.select(
        "unit",
        F.ceil(F.col("bytes") / (2 * BLOCK_BYTES)).cast("int").alias("n"),
        F.ceil(F.col("queries") / BLOCK_QUERIES).cast("int").alias("m"),
    )

    def spread(rows: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod("k1", F.col("n" if own == "i" else "m")).cast("int")
        others = F.sequence(F.lit(0), F.col("m" if own == "i" else "n") - 1)
        return (
            rows.join(sizes, "unit")
            .withColumn(own, block)
            .withColumn(other, F.explode(others))
            .select("unit", "i", "j", "kind", "k1", "k2", "codes", "ids", "dim", "v")
        )

    both = spread(_placed(index, sides[0]), "i", "j").union(
        spread(_placed(queries, sides[1]), "j", "i")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("unit", "i", "j", "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for at, to in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if to == at:
                    continue
                key, part = tuple(keys[:3, at]), batch.slice(at, to - at)
                if key != now:
                    now, parts, block = key, [], None
                if keys[3, at] == 0:
                    parts.append(part)
                    continue
                if block is None and parts:
                    block, parts = _Block(parts, kind), []
                for first in range(0, part.num_rows if block else 0, CHUNK):
                    yield block.answer(part.slice(first, CHUNK), kind, k)

    return (
        both.repartition("unit", "i", "j")
        .sortWithinPartitions("unit", "i", "j", "kind")
        .mapInArrow(run, _FOUND)
    )


def _clean(vectors: DataFrame, queries: Column, id: str, vector: str) -> tuple[DataFrame, str]:
    """Distinct rows ``id, v, query`` that take part, and the type of a packed component."""
    item = vectors.schema[vector].dataType.elementType.simpleString()
    item = "float" if item == "float" else "double"
    rows = vectors.select(
        F.col(id).cast("long").alias("id"),
        # Adding zero turns a negative zero into a positive one.
        F.transform(F.col(vector).cast(f"array<{item}>"), lambda x: x + F.lit(0).cast(item)).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("query"),
    )
    infinite = F.lit(float("inf"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    proper = rows.where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd & F.exists("v", lambda x: x != 0)
    )
    return proper.groupBy("id", "v").agg(F.max("query").alias("query")), item


def _packed(rows: DataFrame, item: str) -> DataFrame:
    """``k1, k2, ids, dim, norm`` and the vector as bytes."""
    kind = "<f4" if item == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            flat, ends = _flat(column).astype(kind), np.asarray(column.value_lengths()).cumsum()
            rows = np.split(flat, ends[:-1]) if len(column) else []
            # Scaled first, so that large components do not overflow.
            large = [float(np.abs(r).max()) for r in rows]
            norms = [m * float(np.sqrt(((r.astype(float) / m) ** 2).sum())) for r, m in zip(rows, large, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1"),
                    batch.column("k2"),
                    batch.column("ids"),
                    pa.array([len(r) for r in rows], pa.int32()),
                    pa.array(norms, pa.float64()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                names=["k1", "k2", "ids", "dim", "norm", "v"],
            )

    keyed = rows.select(
        F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"), "ids", "v"
    )
    return keyed.mapInArrow(
        run, "k1 LONG, k2 LONG, ids ARRAY<LONG>, dim INT, norm DOUBLE, v BINARY"
    )


def _spaces(index: DataFrame, item: str) -> list[Space]:
    """A space per dimension and factor of two in the norm, from the longest on down.

    Read from a histogram of norms in eighths of a factor of two: its size is bounded by
    the range of floating-point numbers, whatever the rows.
    """
    cell = F.floor(8 * F.log2("norm"))
    cells = (
        index.groupBy("dim", cell.alias("cell"))
        .agg(F.min("norm").alias("least"), F.max("norm").alias("top"), F.count(F.lit(1)).alias("rows"))
        .orderBy("dim", F.desc("cell"))
        .collect()
    )
    bands: list[list] = []
    for c in cells:
        if bands and bands[-1][0].dim == c.dim and c.least > bands[-1][0].top / 2:
            bands[-1].append(c)
        else:
            bands.append([c])
    made = []
    for band in bands:
        dim, rows = band[0].dim, sum(c.rows for c in band)
        width = 4 if item == "float" else 8
        shards = max(1, -(-rows * dim * width // BLOCK_BYTES))
        low = float(np.nextafter(min(c.least for c in band), 0))
        made.append(Space(dim, low, band[0].top, rows, int(shards), _axes(rows, dim)))
    return made


def _fitted(index: DataFrame, queries: DataFrame, spaces: list[Space], kind: str, k: int, recall: float) -> list[Space]:
    """Spaces with the number of buckets to visit, from a sample of queries.

    Half of the sample are the vectors that most rows ask for, the others those with the
    smallest keys, which stand for all the rest. Every task scans its vectors for the
    ``k`` nearest of each sampled query and tells where these stand in the query's order
    of buckets, in the best table; the ``k`` nearest of all come to the driver.
    """
    asking = F.col("ids")[0]
    sample = queries.orderBy(F.desc(asking), "k1", "k2").limit(SAMPLE_QUERIES // 2).collect()
    heavy = queries.sparkSession.createDataFrame([(r.k1, r.k2) for r in sample], "k1 LONG, k2 LONG")
    others = queries.join(F.broadcast(heavy), ["k1", "k2"], "left_anti")
    rest = others.orderBy("k1", "k2").limit(SAMPLE_QUERIES // 2).collect()
    weights = [r.ids[0] for r in sample]
    if rest:
        weights += [others.agg(F.sum(asking)).first()[0] / len(rest)] * len(rest)
    sample += rest
    by_dim: dict[int, list[int]] = {}
    for n, row in enumerate(sample):
        by_dim.setdefault(row.dim, []).append(n)
    points = {
        dim: np.stack([np.frombuffer(sample[n].v, kind).astype(float) for n in which])
        for dim, which in by_dim.items()
    }
    keys = np.array([(r.k1, r.k2) for r in sample], np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders: dict = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 8 * CHUNK):
                batch = whole.slice(at, 8 * CHUNK)
                dims, norms = np.asarray(batch.column("dim")), np.asarray(batch.column("norm"))
                held = _spaces_of(dims, norms, spaces)
                own = np.stack([np.asarray(batch.column(c)) for c in ("k1", "k2")], axis=1)
                for s, space in enumerate(spaces):
                    rows = np.flatnonzero(held == s)
                    if len(rows) == 0 or space.dim not in by_dim:
                        continue
                    vectors = _matrix(batch.column("v").take(pa.array(rows)), space.dim, kind)
                    who = np.array(by_dim[space.dim])
                    product = points[space.dim] @ vectors.T
                    same = (keys[who][:, None, :] == own[rows][None, :, :]).all(axis=2)
                    product[same] = -np.inf
                    first = np.array([x[0] for x in batch.column("ids").take(pa.array(rows)).to_pylist()])
                    by_id = np.argsort(first, kind="stable")
                    best = by_id[np.argsort(-product[:, by_id], axis=1, kind="stable")[:, :k]]
                    i, j = np.repeat(np.arange(len(who)), best.shape[1]), best.ravel()
                    score = product[i, j]
                    i, j, score = i[score > -np.inf], j[score > -np.inf], score[score > -np.inf]
                    place = np.full(len(i), MAX_PROBES)
                    unique, at_row = np.unique(j, return_inverse=True)
                    for table in range(TABLES):
                        codes = codes_of(vectors[unique], space, table)[at_row]
                        if (s, table) not in orders:
                            orders[s, table] = probed(points[space.dim], space, table, MAX_PROBES)[1]
                        directions = _directions(points[space.dim], space)
                        for q in range(len(who)):
                            mine = np.flatnonzero(i == q)
                            one = np.repeat(directions[q : q + 1], len(mine), axis=0)
                            value = _bucket_scores(one, codes[mine], space, table)
                            # The last place among equal scores.
                            ahead = np.searchsorted(-orders[s, table][q], -value + 1e-12, side="right") - 1
                            ahead[ahead >= MAX_PROBES - 1] = MAX_PROBES
                            place[mine] = np.minimum(place[mine], ahead)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(who[i], pa.int32()),
                            pa.array(score),
                            pa.array(first[j], pa.int64()),
                            pa.array(np.full(len(i), s, np.int32)),
                            pa.array(place, pa.int64()),
                        ],
                        names=["query", "score", "first", "space", "place"],
                    )

    near = index.mapInArrow(run, "query INT, score DOUBLE, first LONG, space INT, place LONG")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first", "place")
    nearest = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    places: dict[int, list[tuple]] = {}
    for row in nearest.select("query", "space", "place").collect():
        places.setdefault(row.space, []).append((row.place, weights[row.query]))
    fitted = {}
    for s, found in places.items():
        place, weight = (np.array(x) for x in zip(*sorted(found), strict=True))
        reached = np.cumsum(weight) >= recall * weight.sum() - 1e-9
        fitted[s] = int(place[reached.argmax()]) + 1
    least = max(fitted.values(), default=1)
    made = []
    for s, space in enumerate(spaces):
        probes = fitted.get(s, least)
        buckets = np.prod([2.0 * a for a in space.axes])
        whole = probes > MAX_PROBES or probes >= buckets
        made.append(Space(**{**space.__dict__, "probes": None if whole else probes}))
    return made


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each row where ``queries`` holds.

    Result: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``, nearest first, ties to the
    smaller id. The score is the inner product in double precision. A row is no
    neighbour of itself; a query with fewer candidates gets all. Rows whose id or vector
    is NULL, and vectors that are empty, zero, or hold a NULL or non-finite component
    take no part; vectors of another dimension are not compared; repeated rows count
    once, and an id with two vectors is two rows. No rows give no rows.

    Equal vectors are one class, of which the ``k + 1`` smallest ids are enough, so the
    index holds each vector once per table. A query whose buckets hold fewer than ``k``
    neighbours is asked again of all buckets. Runs jobs; tables go to the shared folder.
    """
    rows, item = _clean(vectors, queries, id, vector)
    kind = "<f4" if item == "float" else "<f8"
    order = Window.partitionBy("v").orderBy("id")
    first = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    index = Stored(_packed(classes, item)).frame
    asked = rows.where("query")
    # In place of ids a query vector has the number of rows that ask for it.
    counted = asked.groupBy("v").agg(F.array(F.count(F.lit(1))).alias("ids"))
    asking = Stored(_packed(counted, item)).frame
    spaces = _fitted(index, asking, _spaces(index, item), kind, k, recall)

    def search(questions: DataFrame, everywhere: bool) -> DataFrame:
        sides = tuple(_Side(spaces, kind, q, 1 if everywhere else TABLES, everywhere) for q in (False, True))
        found = _met(index, questions, sides, k + 1)
        # A pair met in two tables has the same score, and so the same place.
        best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.col("ids")[0], "c1", "c2")
        top = found.withColumn("n", F.dense_rank().over(best)).where(F.col("n") <= k + 1)
        members = top.dropDuplicates(["k1", "k2", "n"]).select(
            "k1", "k2", "c1", "c2", "score", F.explode("ids").alias("vec_id")
        )
        order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id", "c1", "c2")
        return Stored(
            members.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        ).frame

    found = search(asking, everywhere=False)
    # As many rows as a query can have at most, its own among them.
    there = index.groupBy("dim").agg(F.least(F.sum(F.size("ids")), F.lit(k + 1)).alias("there"))
    counts = found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("got"))
    short = asking.join(there, "dim").join(counts, ["k1", "k2"], "left").where(
        F.coalesce("got", F.lit(0)) < F.col("there")
    )
    short = Stored(short.select(*asking.columns)).frame
    if not short.isEmpty():
        again = search(short, everywhere=True)
        found = found.join(short.select("k1", "k2"), ["k1", "k2"], "left_anti").union(again)
    keyed = asked.select(
        F.col("id").alias("query_id"), F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")
    )
    own = (
        (F.col("query_id") == F.col("vec_id"))
        & (F.col("k1") == F.col("c1"))
        & (F.col("k2") == F.col("c2"))
    )
    order = Window.partitionBy("query_id", "k1", "k2").orderBy("n")
    return (
        keyed.join(found, ["k1", "k2"])
        .where(~own)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

"""Shared parts of the two similarity operators: sets, sketches and exact checks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bytetext import mix

SHINGLE = 5
SIMILARITY = 0.8
#: A group is checked in pairs of blocks of about this many sets and values.
BLOCK_SETS = 1024
BLOCK_VALUES = 1 << 20
#: Common values and pairs that are counted together.
AT_ONCE = 1 << 18

_FACTORS = np.random.default_rng(1729).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def set_key(values: np.ndarray) -> int:
    """64-bit fingerprint of a set of hashes, as a signed number; 0 for the empty set."""
    made = mix(np.array([mix(values).sum() + np.uint64(len(values))], np.uint64))
    return int(made.view(np.int64)[0]) if len(values) else 0


def minima(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``size`` MinHash values of each set that is not empty, one row per set."""
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    found = np.empty((len(sets), size), np.uint32)
    for k in range(size):
        mixed = flat * _FACTORS[k]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _FACTORS[255 - k]
        found[:, k] = np.minimum.reduceat(mixed, starts) >> np.uint64(32)
    return found


class Forest:
    """Union-find that keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def in_blocks(members: DataFrame, group: str, sizes: DataFrame, key: str = "key") -> DataFrame:
    """Every member once for each pair of blocks it takes part in.

    ``sizes`` has ``group`` and its number of ``blocks``. Adds ``i`` <= ``j``, the pair,
    and ``own``, the member's block. A group of any size becomes tasks of bounded size,
    each of which sees all pairs of its two blocks.
    """
    placed = members.join(sizes.select(group, "blocks"), group).withColumn(
        "own", F.pmod(F.xxhash64(key, F.lit(3)), "blocks").cast("int")
    )
    others = F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))
    return (
        placed.withColumn("other", F.explode(others))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", "blocks")
    )


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]):
    """Yield (first, counts): common values of left sets from ``first`` on with all right sets."""
    values = np.concatenate([*right, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(right)), [len(x) for x in right])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    at, held, cost = 0, [], 0
    for k, x in enumerate(left):
        lo, hi = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
        held.append((lo, hi))
        cost += int((hi - lo).sum())
        if cost > AT_ONCE or (k + 1 - at) * len(right) > AT_ONCE or k == len(left) - 1:
            lo = np.concatenate([h[0] for h in held])
            n = np.concatenate([h[1] for h in held]) - lo
            row = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
            first = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            met = owner[first + np.arange(len(first))]
            cell = np.repeat(row, n) * len(right) + met
            yield at, np.bincount(cell, minlength=len(held) * len(right)).reshape(-1, len(right))
            at, held, cost = k + 1, [], 0


_CHECKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def checked(rows: DataFrame, group: str, similarity: float = SIMILARITY) -> DataFrame:
    """Exact Jaccard over all pairs in pairs of blocks.

    ``rows`` come from :func:`in_blocks` and have ``key``, ``weight`` and ``values``
    (sorted distinct hashes, packed as bytes). Result: links (a, b) that connect what
    is connected inside each pair of blocks, with NULL ``n``; and for every key with a
    similar one (a, NULL, n), the weight of the keys similar to it in that pair.
    """

    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        keys = np.asarray(table.column("key"))
        weight, own = np.asarray(table.column("weight")), np.asarray(table.column("own"))
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in table.column("values")]
        size = np.array([len(s) for s in sets])
        order = np.argsort(keys, kind="stable")
        left = [x for x in order if own[x] == i]
        right = left if i == j else [x for x in order if own[x] == j]
        linked = np.zeros(len(keys), np.int64)
        trees = Forest(len(keys))
        at_right = np.array(right, np.int64)
        if left and right:
            for first, common in _overlaps([sets[x] for x in left], [sets[x] for x in right]):
                at_left = np.array(left[first : first + len(common)], np.int64)
                union = size[at_left][:, None] + size[at_right][None, :] - common
                near = (common > 0) & (common >= similarity * union - 1e-9)
                near &= at_left[:, None] != at_right[None, :]
                linked[at_left] += near @ weight[at_right]
                if i != j:
                    np.add.at(linked, at_right, weight[at_left] @ near)
                for a, b in zip(*np.nonzero(near), strict=True):
                    trees.join(int(at_left[a]), int(at_right[b]))
        touched = np.flatnonzero(linked)
        a = [*[keys[x] for x, _ in trees.links], *keys[touched]]
        b = [*[int(keys[y]) for _, y in trees.links], *[None] * len(touched)]
        n = [*[None] * len(trees.links), *[int(v) for v in linked[touched]]]
        return pa.table(
            [pa.array([int(x) for x in a], pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
            schema=_CHECKED,
        )

    return rows.groupBy(group, "i", "j").applyInArrow(run, "a LONG, b LONG, n LONG")


def block_counts(members: DataFrame, group: str) -> DataFrame:
    """``group`` and the number of blocks its sets are checked in; members have ``size``."""
    return members.groupBy(group).agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_VALUES), F.lit(1)
        )
        .cast("int")
        .alias("blocks")
    )

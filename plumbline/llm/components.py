"""Connected components of a link table, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import Stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``root``, the smallest id of its component, of every id in a link.

    Large-star and small-star rounds: a round hangs each node's larger, then its
    smaller neighbours under the smallest one, until nothing changes. A node with
    many links is pre-aggregated to one minimum and its links stay separate rows, so
    no group is held in one task. Each round is written to the shared folder and the
    round before it deleted. NULL ids and links of an id to itself are left out.
    """
    u, v = F.col("u"), F.col("v")
    pairs = (
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where(u.isNotNull() & v.isNotNull() & (u != v))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
    )
    now = Stored(pairs)
    state = _state(now.frame)
    while state[0]:
        after = Stored(_small_star(_large_star(now.frame)))
        now.drop()
        now, before, state = after, state, _state(after.frame)
        if state == before:
            break
    # In the end every node but the root hangs directly under the root.
    roots = now.frame.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return now.frame.select(F.col("u").alias("id"), F.col("v").alias("root")).union(roots)


def _state(pairs: DataFrame) -> tuple:
    """Count and content sum of the links: equal only if a round changed nothing."""
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    # Only neighbours larger than the node move: these are the pairs (larger, node).
    return (
        pairs.join(least.withColumnRenamed("u", "v"), "v")
        .select("u", F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return (
        pairs.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )

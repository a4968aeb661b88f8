"""Negative sampling: distinct items that the user never touched.

A user's unseen items are numbered 0 .. free - 1 in catalogue order without ever
being listed: unseen number ``c`` sits at catalogue position ``c`` plus the number
of own items before it. Drawing ``k`` distinct numbers below ``free`` therefore
gives ``k`` unseen items at once, with no rejection, no retry and no pair table.

The number of own items before a draw is found by halving in the user's sorted own
positions, so draws are neither sorted nor shuffled. An array holds at most ``CHUNK``
positions: a user with more has several, told apart by a directory of their first
numbers, and their draws look up the one they fall in. The catalogue is read in pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import hash_number
from plumbline.operators.interactions import label_rows, user_items
from plumbline.operators.ordering import running_total
from plumbline.sources.state import cut_lineage

#: Own positions of a user in one array.
CHUNK = 1024
#: Items of the catalogue in one row of its pages.
PAGE = 256
#: Numbers that may travel to every task at once (8 bytes each); more are joined by a shuffle.
SMALL = 10_000_000


def catalogue(df: DataFrame, item: str = "movie_id") -> DataFrame:
    """Items that occur in ``df`` with a 0-based ``position`` in item order."""
    items = df.select(item).where(F.col(item).isNotNull()).distinct()
    numbered = running_total(items, [F.col(item)], out="position")
    return numbered.withColumn("position", F.col("position") - 1)


def negative_samples(
    positives: DataFrame,
    k: int = 5,
    seed: int = 42,
    user: str = "user_id",
    item: str = "movie_id",
    qid: str = "qid",
    strict: bool = False,
    blocks: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """For every row of ``positives``, ``k`` copies with an unseen item each, label 0.

    ``qid`` identifies a row. A user with fewer than ``k`` unseen items gets all of
    them, or an error if ``strict``. The catalogue and each user's item positions are
    stored when the function is called; ``blocks`` is passed to the running total that
    cuts the positions of users with more than ``chunk`` items.
    """
    items = cut_lineage(catalogue(positives, item))
    n_items = items.count()
    owned = cut_lineage(
        user_items(positives, user, item)
        .join(items, item)
        .select(user, F.col("position").alias("__own"))
    )
    sizes = cut_lineage(owned.groupBy(user).agg(F.count(F.lit(1)).alias("__size")))
    if strict and not sizes.where(n_items - F.col("__size") < k).isEmpty():
        raise ValueError(f"some users have fewer than {k} unseen items")
    large = sizes.where(F.col("__size") > chunk)
    n_large = large.agg(F.sum("__size").alias("n")).first()["n"]
    draws = [F.lit(n_items), k, seed, qid]
    if n_large:
        few, many = (owned.join(large.select(user), user, how) for how in ("left_anti", "left_semi"))
        placed = _draw(positives, few, user, chunk, *draws).unionByName(
            _draw_from_many(positives, many, n_large, n_items, user, chunk, blocks, *draws)
        )
    else:
        placed = _draw(positives, owned, user, chunk, *draws)
    return label_rows(_named(placed, items, n_items, item).select(*positives.columns), 0)


def with_negatives(
    positives: DataFrame, k: int = 5, seed: int = 42, **columns
) -> DataFrame:
    """Positives with label 1 and their sampled negatives with label 0."""
    negatives = negative_samples(positives, k, seed, **columns)
    return label_rows(positives, 1).unionByName(negatives)


def _with_draws(df: DataFrame, free: Column, k: int, seed: int, qid: str) -> DataFrame:
    """``df`` with a row per draw: ``least(k, free)`` distinct numbers ``__at`` below ``free``
    (Floyd's method).

    A column per draw, each from the ones before it, so that Spark compiles them; a lambda
    over an array is interpreted step by step.
    """
    size = F.least(F.lit(k).cast("long"), F.greatest(free, F.lit(0).cast("long")))
    drawn = df.withColumns({"__base": free - size, "__draws": size})
    names = [f"__draw_{j}" for j in range(k)]
    for j, name in enumerate(names):
        top = F.col("__base") + j
        number = hash_number(F.lit(seed), F.col(qid), F.lit(j))
        picked = drawn.withColumn("__pick", F.when(F.col("__draws") > j, number % (top + 1)))
        again = F.col("__pick").isin(*[F.col(n) for n in names[:j]]) if j else F.lit(False)
        drawn = picked.withColumn(name, F.when(again, top).otherwise(F.col("__pick")))
    return (
        drawn.withColumn("__at", F.explode(F.array(*names)))
        .drop(*names, "__base", "__draws", "__pick")
        .where(F.col("__at").isNotNull())
    )


def _up_to(df: DataFrame, ordered: str, value: Column, most: int, out: str) -> DataFrame:
    """Add how many numbers of an ascending array of at most ``most`` are up to ``value``, by
    halving: a compiled column per step."""
    found = df.withColumn(out, F.lit(0))
    for bit in reversed(range(max(1, most).bit_length())):
        step = F.lit(1 << bit)
        reached = F.get(ordered, F.col(out) + step - 1) <= value
        found = found.withColumn(out, F.col(out) + F.when(reached, step).otherwise(F.lit(0)))
    return found


def _gaps() -> Column:
    """For each own item in catalogue order, own position less its number among them."""
    owned = F.sort_array(F.collect_list("__own"))
    return F.transform(owned, lambda own, i: own - i).alias("__gaps")


def _draw(
    positives: DataFrame,
    owned: DataFrame,
    user: str,
    chunk: int,
    n_items: Column,
    k: int,
    seed: int,
    qid: str,
) -> DataFrame:
    """Rows of users with at most ``chunk`` own items, and the ``__position`` of each draw."""
    # Stored, it is a plain side of the join, so a hot user's rows can be split.
    arrays = cut_lineage(owned.groupBy(user).agg(_gaps()))
    known = positives.join(arrays, user).select(*positives.columns, "__gaps")
    free = n_items - F.size("__gaps").cast("long")
    drawn = _with_draws(known, free, k, seed, qid)
    placed = _up_to(drawn, "__gaps", F.col("__at"), chunk, "__before")
    position = F.col("__at") + F.col("__before")
    return placed.select(*positives.columns, position.alias("__position"))


def _draw_from_many(
    positives: DataFrame,
    owned: DataFrame,
    n_owned: int,
    n_catalogue: int,
    user: str,
    chunk: int,
    blocks: int | None,
    n_items: Column,
    k: int,
    seed: int,
    qid: str,
) -> DataFrame:
    """The same for users with more own items: a draw is first placed among the chunks."""
    ranked = running_total(owned, [F.col("__own")], by=[user], out="__rank", blocks=blocks)
    part = F.floor((F.col("__rank") - 1) / chunk).cast("int").alias("__chunk")
    chunks = cut_lineage(ranked.groupBy(user, part).agg(_gaps()))
    base = F.col("__chunk").cast("long") * chunk
    first = F.struct("__chunk", (F.get("__gaps", F.lit(0)) - base).alias("at"))
    directory = cut_lineage(
        chunks.groupBy(user).agg(
            F.sort_array(F.collect_list(first))["at"].alias("__firsts"),
            F.sum(F.size("__gaps")).cast("long").alias("__size"),
        )
    )
    known = positives.join(directory, user).select(*positives.columns, "__firsts", "__size")
    free = n_items - F.col("__size")
    drawn = _with_draws(known, free, k, seed, qid)
    most = n_catalogue // chunk + 1
    reached = _up_to(drawn, "__firsts", F.col("__at"), most, "__before")
    placed = reached.withColumn("__chunk", F.greatest(F.col("__before") - 1, F.lit(0)))
    looked = placed.drop("__firsts", "__size", "__before").join(
        F.broadcast(chunks) if n_owned <= SMALL else chunks, [user, "__chunk"]
    )
    before = _up_to(looked, "__gaps", F.col("__at") + base, chunk, "__before")
    position = F.col("__at") + base + F.col("__before")
    return before.select(*positives.columns, position.alias("__position"))


def _named(placed: DataFrame, items: DataFrame, n_items: int, item: str) -> DataFrame:
    """``placed`` with the item at ``__position``."""
    pages = cut_lineage(
        items.groupBy(_page("position").alias("__page")).agg(
            F.sort_array(F.collect_list(F.struct("position", item)))[item].alias("__items")
        )
    )
    within = (F.col("__position") % PAGE).cast("int")
    return (
        placed.drop(item)
        .withColumn("__page", F.coalesce(_page("__position"), F.lit(-1).cast("long")))
        .join(F.broadcast(pages) if n_items <= SMALL else pages, "__page")
        .withColumn(item, F.get("__items", within))
    )


def _page(position: str) -> Column:
    return F.shiftright(F.col(position), PAGE.bit_length() - 1)

"""Interaction tables: recency rank, query ids, splits, user sampling, popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import hash_number
from plumbline.operators.ordering import row_numbers
from plumbline.sources.state import cut_lineage


def number_interactions(
    df: DataFrame,
    user: str = "user_id",
    time: Column | str = "timestamp",
    keys: Sequence[str] = ("movie_id",),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``interaction_num`` (1 = the user's latest) and a unique 0-based ``qid``.

    ``time`` is a number such as epoch seconds; ``keys`` break ties and, with user
    and time, must identify a row. ``keep`` names the columns to return, if not all.
    """
    latest_first = -(F.col(time) if isinstance(time, str) else time)
    return row_numbers(
        df,
        [latest_first, *[F.col(k) for k in keys]],
        by=[user],
        within="interaction_num",
        overall="qid",
        keep=keep,
    )


def user_items(df: DataFrame, user: str = "user_id", item: str = "movie_id") -> DataFrame:
    """Each user's items as distinct (user, item) rows, never as one array per user."""
    return df.select(user, item).distinct()


def drop_seen(
    candidates: DataFrame,
    interactions: DataFrame,
    user: str = "user_id",
    item: str = "movie_id",
) -> DataFrame:
    """Candidate rows whose user has not touched the item."""
    return candidates.join(user_items(interactions, user, item), [user, item], "left_anti")


def label_rows(df: DataFrame, label: int, out: str = "label") -> DataFrame:
    return df.withColumn(out, F.lit(label))


def sample_users(df: DataFrame, n: int, seed: int = 42, user: str = "user_id") -> DataFrame:
    """``n`` distinct users in md5 order of (seed, user): same seed, same users."""
    return (
        df.select(user)
        .distinct()
        .orderBy(hash_number(F.lit(seed), F.col(user)), user)
        .limit(n)
    )


def assign_split(
    df: DataFrame,
    n_test_users: int = 100,
    seed: int = 42,
    user: str = "user_id",
    recency: str = "interaction_num",
    out: str = "split",
    sample_from: DataFrame | None = None,
) -> DataFrame:
    """Leave-latest-out: rows of the latest interaction are ``test`` for sampled users
    and ``val`` for the others; all earlier rows are ``train``.

    The users are drawn when the function is called, from ``sample_from`` if given:
    a narrower table with the same users.
    """
    latest = F.col(recency) == 1
    source = df.where(latest) if sample_from is None else sample_from
    sampled = cut_lineage(
        sample_users(source, n_test_users, seed, user).select(
            F.col(user).alias("__test_user")
        )
    )
    joined = df.join(sampled, F.col(user) == F.col("__test_user"), "left")
    split = (
        F.when(~latest, F.lit("train"))
        .when(F.col("__test_user").isNotNull(), F.lit("test"))
        .otherwise(F.lit("val"))
    )
    return joined.withColumn(out, split).drop("__test_user")


def split_of(df: DataFrame, name: str, column: str = "split") -> DataFrame:
    return df.where(F.col(column) == name).drop(column)


def popular_items(df: DataFrame, k: int, item: str = "movie_id") -> DataFrame:
    """The ``k`` items with most interactions; ties by item id."""
    return (
        df.groupBy(item)
        .agg(F.count(F.lit(1)).alias("interactions"))
        .orderBy(F.desc("interactions"), item)
        .limit(k)
    )

"""Value counts, shares and target rates.

Each table is one hash aggregate with map-side combine, so a hot value costs one
partial row per task. Totals travel as scalar subqueries over the same grouped
table, whose shuffle Spark reuses, never as an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import (
    MISSING,
    OTHERS,
    TOTAL,
    as_text,
    present_text,
    share,
    unreserved,
)
from plumbline.functions.frames import null_safe_join, one_row


def value_counts(df: DataFrame, column: str, sort_by: str | None = None) -> DataFrame:
    """``var, value, count, proportion`` with one ``missing`` and one ``total`` row.

    The ``missing`` row is always there and holds the number of NULLs and NaNs. A text
    in the data that reads ``missing`` or ``total`` is shown in quotes, so each of the
    two names occurs once. ``sort_by`` names an output column to sort by, descending
    for numbers.
    """
    rows = df.select(present_text(df, column).alias("value"), F.lit(1).alias("weight"))
    # A zero-weight NULL row makes sure that the missing group exists.
    empty = one_row(df, value=F.lit(None).cast("string"), weight=F.lit(0))
    counts = (
        rows.unionByName(empty)
        .groupBy("value")
        .agg(F.sum("weight").alias("count"))
    )
    total = counts.agg(F.sum("count").alias("count"))
    named = counts.withColumn("value", F.coalesce(unreserved("value"), F.lit(MISSING)))
    table = named.unionByName(total.select(F.lit(TOTAL).alias("value"), "count"))
    result = table.select(
        F.lit(column).alias("var"),
        "value",
        "count",
        share(F.col("count"), total.scalar()).alias("proportion"),
    )
    if sort_by in ("count", "proportion"):
        return result.orderBy(F.desc(sort_by), "value")
    return result.orderBy(sort_by) if sort_by else result


def value_counts_with_total(df: DataFrame, column: str) -> DataFrame:
    """``value, count, percentage`` with a ``total`` row; NULL is a group if it occurs."""
    counts = df.groupBy(as_text(column).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))
    table = counts.unionByName(total.select(F.lit(TOTAL).alias("value"), "count"))
    return table.withColumn("percentage", share(F.col("count"), total.scalar()))


def value_counts_within(df: DataFrame, column: str, by: str) -> DataFrame:
    """:func:`value_counts_with_total` for each ``by`` group, from one aggregate."""
    counts = df.groupBy(by, as_text(column).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    totals = counts.groupBy(by).agg(F.sum("count").alias("count"))
    shares = with_share_of(counts, [by], out="percentage")
    return shares.unionByName(
        totals.select(
            by, F.lit(TOTAL).alias("value"), "count", F.lit(1.0).alias("percentage")
        )
    )


def stats_by_value(
    df: DataFrame,
    column: str,
    target: str | None = None,
    out: str = "target",
    drop_unit_target: bool = False,
) -> DataFrame:
    """Per value its count, share of all rows and, given a target, the target mean.

    ``drop_unit_target`` leaves the mean out when it is 1 for every value; that
    check runs a job when the function is called.
    """
    means = [F.avg(target).alias("__mean")] if target else []
    counts = df.groupBy(as_text(column).alias(column)).agg(
        F.count(F.lit(1)).alias("count"), *means
    )
    total = counts.agg(F.sum("count"))
    table = counts.select(
        column,
        "count",
        share(F.col("count"), total.scalar()).alias("proportion"),
        *([F.col("__mean").alias(out)] if target else []),
    )
    if target and drop_unit_target:
        if table.where(~F.col(out).eqNullSafe(F.lit(1.0))).isEmpty():
            return table.drop(out)
    return table


def stats_over_time(df: DataFrame, column: str, time: str) -> DataFrame:
    """Per time bucket and value the count and the share within the bucket."""
    counts = df.groupBy(time, as_text(column).alias(column)).agg(
        F.count(F.lit(1)).alias("count")
    )
    return with_share_of(counts, [time])


def with_share_of(
    counts: DataFrame, by: Sequence[str], count: str = "count", out: str = "proportion"
) -> DataFrame:
    """Share of each row's count in the total of its ``by`` group.

    The group totals are joined back rather than taken from a window, so a group
    with very many values is never gathered in one task.
    """
    totals = counts.groupBy(*by).agg(F.sum(count).alias("__total"))
    joined = null_safe_join(counts, totals, by, "inner")
    return joined.withColumn(out, share(F.col(count), F.col("__total"))).drop("__total")


def target_rate_over_time(
    df: DataFrame, target: str, time: str, out: str = "rate"
) -> DataFrame:
    return mean_over_time(df, target, time, out)


def mean_over_time(df: DataFrame, column: str, time: str, out: str = "mean") -> DataFrame:
    return df.groupBy(time).agg(F.avg(column).alias(out))


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def group_sizes(df: DataFrame, qid: str) -> DataFrame:
    """Rows per query, in query order."""
    return df.groupBy(qid).agg(F.count(F.lit(1)).alias("group_size")).orderBy(qid)


def most_frequent(df: DataFrame, value: Column, k: int) -> DataFrame:
    """One row with an array of the ``k`` most frequent non-NULL values; ties by value."""
    return (
        df.select(value.alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
        .limit(k)
        .agg(F.collect_list("value").alias("values"))
    )


def group_rare(
    df: DataFrame, column: str, bins: int = 10, out: str | None = None
) -> DataFrame:
    """Keep the ``bins`` most frequent values, call the rest ``Others``, NULL and NaN
    ``missing``. Texts in the data that read like these two names are put in quotes."""
    top = most_frequent(df, present_text(df, column), bins)
    text = present_text(df, column)
    grouped = (
        F.when(text.isNull(), F.lit(MISSING))
        .when(F.array_contains("__top", text), unreserved(text, MISSING, OTHERS))
        .otherwise(F.lit(OTHERS))
    )
    return (
        df.withColumn("__top", top.scalar())
        .withColumn(out or column, grouped)
        .drop("__top")
    )


def category_shares(df: DataFrame, column: str, top_k: int = 10) -> DataFrame:
    """``value, share`` of the ``top_k`` values (NULL competes as ``missing``) and ``Others``."""
    own = unreserved(present_text(df, column), MISSING, OTHERS)
    text = F.coalesce(own, F.lit(MISSING))
    top = most_frequent(df, text, top_k)
    named = F.when(F.array_contains("__top", F.col("value")), F.col("value"))
    rows = (
        df.select(text.alias("value"), F.lit(1).alias("weight"))
        .withColumn("__top", top.scalar())
        .withColumn("value", F.coalesce(named, F.lit(OTHERS)))
        .drop("__top")
    )
    others = one_row(df, value=F.lit(OTHERS), weight=F.lit(0))
    counts = rows.unionByName(others).groupBy("value").agg(F.sum("weight").alias("count"))
    total = counts.agg(F.sum("count"))
    return counts.select("value", share(F.col("count"), total.scalar()).alias("share"))


def category_histogram(
    df: DataFrame, column: str, bins: int = 10, targets: Sequence[str] = ()
) -> DataFrame:
    """Grouped values with count, share and the mean of each target (no zero fill)."""
    grouped = group_rare(df, column, bins, out="__group")
    counts = grouped.groupBy(F.col("__group").alias("value")).agg(
        F.count(F.lit(1)).alias("count"),
        *[F.avg(t).alias(f"{t}_mean") for t in dict.fromkeys(targets)],
    )
    total = counts.agg(F.sum("count"))
    return counts.withColumn("share", share(F.col("count"), total.scalar()))


def top_categories(df: DataFrame, column: str, bins: int = 10, n: int = 3) -> DataFrame:
    """The ``n`` largest groups of :func:`category_histogram`."""
    return (
        category_histogram(df, column, bins)
        .orderBy(F.desc("count"), "value")
        .limit(n)
        .select("value", "count", "share")
    )

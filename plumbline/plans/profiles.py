"""Profiles of one feature: the tables behind a distribution overview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.binning import (
    Bins,
    equal_width_bins,
    histogram,
    quantile_bins,
    user_bins,
)
from plumbline.operators.counts import (
    category_histogram,
    group_rare,
    mean_over_time,
    min_max,
    stats_by_value,
    stats_over_time,
    target_rate_over_time,
    top_categories,
)
from plumbline.operators.summaries import boxplot_stats, categorical_summary, numeric_summary

Tables = dict[str, DataFrame]


def numeric_feature(
    df: DataFrame,
    column: str,
    targets: Sequence[str] = (),
    bins: int = 10,
    edges: Sequence[float] | None = None,
    equal_width: bool | None = None,
    method: str = "exact",
) -> Tables:
    """``histogram``, ``summary`` and ``box`` of a numeric column, with target means.

    Bins are the given edges, equal widths (the default with targets) or quantiles.
    """
    if equal_width is None:
        equal_width = bool(targets)
    if edges is not None:
        fitted = user_bins(df.sparkSession, edges)
    elif equal_width:
        fitted = equal_width_bins(df, column, bins)
    else:
        fitted = quantile_bins(df, column, bins, method=method)
    return {
        "histogram": histogram(df, column, fitted, targets),
        "summary": numeric_summary(df, column, targets, method),
        "box": boxplot_stats(df, column, method=method),
    }


def categorical_feature(
    df: DataFrame, column: str, targets: Sequence[str] = (), bins: int = 10
) -> Tables:
    """``histogram``, ``summary`` and ``top`` of a categorical column."""
    return {
        "histogram": category_histogram(df, column, bins, targets),
        "summary": categorical_summary(df, column, targets),
        "top": top_categories(df, column, bins),
    }


def numeric_profile(
    df: DataFrame,
    column: str,
    time: str,
    target: str | None = None,
    bins: int = 10,
    method: str = "exact",
) -> Tables:
    """A numeric column overall, over time and as box plots; the target is optional."""
    fitted: Bins = quantile_bins(df, column, bins, method=method)
    keep = [time] if target is None else [time, target]
    binned = fitted.label(df.select(column, *keep), column, "__bin").select(
        F.col("__bin").alias(column), *keep
    )
    return {
        "overall": stats_by_value(binned, column, target),
        "over_time": stats_over_time(binned, column, time),
        "box": boxplot_stats(df, column, [time], method),
        "mean": mean_over_time(df, column, time),
        "range": min_max(df, column),
    }


def categorical_profile(
    df: DataFrame, column: str, time: str, target: str | None = None, bins: int = 10
) -> Tables:
    """A categorical column overall and over time.

    The target may be the column itself; its mean is then called ``target_rate``.
    """
    out = "target_rate" if column == "target" else "target"
    keep = [F.col(time)] + ([] if target is None else [F.col(target).alias("__target")])
    source = df.select(F.col(column).alias("__value"), *keep)
    grouped = group_rare(source, "__value", bins).withColumnRenamed("__value", column)
    overall = stats_by_value(grouped, column, None if target is None else "__target", out)
    return {
        "overall": overall,
        "over_time": stats_over_time(grouped, column, time),
    }


def label_profile(df: DataFrame, label: str, time: str) -> Tables:
    """A 0/1 label overall, over time, and its rate over time."""
    return {
        "overall": stats_by_value(df, label),
        "over_time": stats_over_time(df, label, time),
        "rate": target_rate_over_time(df, label, time),
    }

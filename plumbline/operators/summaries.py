"""One-row summaries and box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import number, present
from plumbline.functions.frames import attach, pin
from plumbline.operators.quantiles import quantile_columns, quantiles

QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
WHISKER_REACH = 1.5


def numeric_summary(
    df: DataFrame, column: str, targets: Sequence[str] = (), method: str = "exact"
) -> DataFrame:
    """Count, missing, mean, sample std, min, max and quartiles; per target its mean
    and std over the rows where the feature is present."""
    value = number(column)
    aggregates = {
        "count": F.count(value),
        "missing": F.count_if(value.isNull()),
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
        "min": F.min(value),
        "max": F.max(value),
        **_target_stats(df, value, targets),
    }
    table = quantiles(df, column, list(QUARTILES.values()), method=method, extra=aggregates)
    return quantile_columns(table, QUARTILES)


def categorical_summary(
    df: DataFrame, column: str, targets: Sequence[str] = ()
) -> DataFrame:
    """Distinct values (NULL counts as one), rows, NULLs, and target mean and std over
    the rows where the feature is present."""
    value = present(df, column)
    return df.agg(
        (F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("int")), F.lit(0)))
        .cast("long")
        .alias("categories"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(value.isNull()).alias("missing"),
        *[c.alias(n) for n, c in _target_stats(df, value, targets).items()],
    )


def _target_stats(df: DataFrame, value: Column, targets: Sequence[str]) -> dict[str, Column]:
    stats: dict[str, Column] = {}
    for target in dict.fromkeys(targets):
        seen = F.when(value.isNotNull(), present(df, target))
        stats[f"{target}_mean"] = F.avg(seen)
        stats[f"{target}_std"] = F.stddev_samp(seen)
    return stats


def boxplot_stats(
    df: DataFrame, column: str, by: Sequence[str] = (), method: str = "exact"
) -> DataFrame:
    """Quartiles, fences at 1.5 IQR, whisker ends, outlier count and mean per group."""
    fences = _fences(df, column, by, method)
    x, low, high = F.col("__x"), F.col("low_fence"), F.col("high_fence")
    inside = F.when((x >= low) & (x <= high), x)
    rows = df.select(*by, number(column).alias("__x")).where("__x is not null")
    ends = (
        attach(rows, fences, by, ["low_fence", "high_fence"])
        .groupBy(*by)
        .agg(
            F.min(inside).alias("__low"),
            F.max(inside).alias("__high"),
            F.count_if((x < low) | (x > high)).alias("outliers"),
        )
    )
    table = attach(fences, ends, by, ["__low", "__high", "outliers"])
    return table.select(
        *by,
        "count",
        "mean",
        *QUARTILES,
        "low_fence",
        "high_fence",
        F.least(F.coalesce("__low", "q1"), F.col("q1")).alias("whisker_low"),
        F.greatest(F.coalesce("__high", "q3"), F.col("q3")).alias("whisker_high"),
        "outliers",
    )


def outliers(
    df: DataFrame, column: str, by: Sequence[str] = (), method: str = "exact"
) -> DataFrame:
    """The rows of ``df`` outside the fences of their group."""
    fences = _fences(df, column, by, method)
    value = number(column)
    marked = attach(df, fences, by, ["low_fence", "high_fence"])
    outside = (value < F.col("low_fence")) | (value > F.col("high_fence"))
    return marked.where(outside).select(*df.columns)


def _fences(df: DataFrame, column: str, by: Sequence[str], method: str) -> DataFrame:
    value = number(column)
    table = quantile_columns(
        quantiles(
            df,
            column,
            list(QUARTILES.values()),
            by,
            method,
            extra={"count": F.count(value), "mean": F.avg(value)},
        ),
        QUARTILES,
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER_REACH
    fenced = table.withColumn("low_fence", F.col("q1") - reach)
    return pin(fenced.withColumn("high_fence", F.col("q3") + reach), by)

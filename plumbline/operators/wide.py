"""Summaries of many numeric columns from one read of the table.

All columns are turned into rows (column, value) and counted at once, with what the
targets add up to. The counts are stored; means, deviations, quantiles, fences and bins
of every column then come from them, with one running total by column. The cost of a
read does not grow with the number of summaries, and a column is never one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import number, present
from plumbline.functions.frames import attach
from plumbline.operators.ordering import running_total
from plumbline.operators.quantiles import _inside, _interpolated, _ranks, quantile_columns
from plumbline.operators.summaries import QUARTILES, WHISKER_REACH
from plumbline.sources.state import cut_lineage

BY = ["column"]


def value_cells(df: DataFrame, columns: Sequence[str], targets: Sequence[str] = ()) -> DataFrame:
    """Stored ``column, value, n`` and, per target, ``<t>__n``, ``<t>__sum``, ``<t>__squares``.

    NaN counts as NULL, which is a value of its own.
    """
    targets = list(dict.fromkeys(targets))
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            number(c).cast("double").alias("value"),
            *[present(df, t).cast("double").alias(f"__t{i}") for i, t in enumerate(targets)],
        )
        for c in columns
    ]
    sums = []
    for i, t in enumerate(targets):
        x = F.col(f"__t{i}")
        sums += [
            F.count(x).alias(f"{t}__n"),
            F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{t}__sum"),
            F.coalesce(F.sum(x * x), F.lit(0.0)).alias(f"{t}__squares"),
        ]
    long = df.select(F.inline(F.array(*cells)))
    return cut_lineage(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), *sums))


def numeric_summaries(
    df: DataFrame,
    columns: Sequence[str],
    targets: Sequence[str] = (),
    cells: DataFrame | None = None,
) -> DataFrame:
    """A row per column: ``count, missing, mean, std, min, max, q1, q2, q3`` and, per target,
    its mean and std over the rows where the column is present.

    ``cells`` saves counting again what :func:`value_cells` has counted.
    """
    cells = cells if cells is not None else value_cells(df, columns, targets)
    n, value = F.col("n"), F.col("value")
    known = cells.where(value.isNotNull())
    stats = []
    for t in dict.fromkeys(targets):
        count, total = F.sum(f"{t}__n"), F.sum(f"{t}__sum")
        spread = F.sum(f"{t}__squares") - total * total / count
        stats += [
            (total / F.nullif(count, F.lit(0))).alias(f"{t}_mean"),
            F.when(count > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (count - 1))).alias(f"{t}_std"),
        ]
    present_rows = known.groupBy(*BY).agg(
        F.sum("n").alias("count"),
        (F.sum(value * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *stats,
    )
    rows = cells.groupBy(*BY).agg(
        F.sum(F.when(value.isNull(), n).otherwise(0)).alias("missing")
    )
    first = cut_lineage(
        attach(rows, present_rows, BY, [c for c in present_rows.columns if c not in BY])
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .withColumn("__n", F.col("count"))
        .withColumn("__ranks", _ranks(list(QUARTILES.values())))
    )
    # Deviations from the mean, not a difference of large sums.
    deviation = F.sum(n * (value - F.col("mean")) * (value - F.col("mean")))
    spread = (
        attach(known, first, BY, ["mean", "count"])
        .groupBy(*BY)
        .agg(F.when(F.max("count") > 1, F.sqrt(deviation / (F.max("count") - 1))).alias("std"))
    )
    placed = running_total(known.select(*BY, "value", "n"), [value], BY, n, out="__end")
    picked = (
        attach(placed, first, BY, ["__ranks"])
        .where(
            F.exists(
                "__ranks",
                lambda r: _inside(r["low"], F.col("__end") - n, F.col("__end"))
                | _inside(r["high"], F.col("__end") - n, F.col("__end")),
            )
        )
        .groupBy(*BY)
        .agg(F.sort_array(F.collect_list(F.struct("__end", value.alias("__x")))).alias("__picked"))
    )
    joined = attach(attach(first, spread, BY, ["std"]), picked, BY, ["__picked"])
    made = joined.withColumn("quantiles", F.transform("__ranks", _interpolated))
    order = ["count", "missing", "mean", "std", "min", "max", *QUARTILES]
    extra = [f"{t}_{s}" for t in dict.fromkeys(targets) for s in ("mean", "std")]
    return quantile_columns(made, QUARTILES).select(*BY, *order, *extra)


def numeric_boxes(
    df: DataFrame, columns: Sequence[str], cells: DataFrame | None = None
) -> DataFrame:
    """A row per column that has a value: quartiles, fences at 1.5 IQR, whisker ends and the
    number of outliers."""
    cells = cells if cells is not None else value_cells(df, columns)
    reach = (F.col("q3") - F.col("q1")) * WHISKER_REACH
    summary = cut_lineage(
        numeric_summaries(df, columns, cells=cells)
        .where("count > 0")
        .withColumn("low_fence", F.col("q1") - reach)
        .withColumn("high_fence", F.col("q3") + reach)
    )
    value, low, high = F.col("value"), F.col("low_fence"), F.col("high_fence")
    inside = F.when((value >= low) & (value <= high), value)
    ends = (
        attach(cells.where(value.isNotNull()), summary, BY, ["low_fence", "high_fence"])
        .groupBy(*BY)
        .agg(
            F.min(inside).alias("__low"),
            F.max(inside).alias("__high"),
            F.sum(F.when((value < low) | (value > high), F.col("n")).otherwise(0)).alias("outliers"),
        )
    )
    return attach(summary, ends, BY, ["__low", "__high", "outliers"]).select(
        *BY,
        "count",
        "mean",
        *QUARTILES,
        "low_fence",
        "high_fence",
        F.least(F.coalesce("__low", "q1"), F.col("q1")).alias("whisker_low"),
        F.greatest(F.coalesce("__high", "q3"), F.col("q3")).alias("whisker_high"),
        "outliers",
    )


def numeric_histograms(
    df: DataFrame,
    columns: Sequence[str],
    bins: int = 10,
    targets: Sequence[str] = (),
    cells: DataFrame | None = None,
) -> DataFrame:
    """``column, bin, low, high, count`` and a mean per target, in ``bins`` equal widths from
    the least to the largest value; a value on an edge lies in the upper bin, the largest
    one in the last. A column with one value has one bin. Empty bins are left out."""
    cells = cells if cells is not None else value_cells(df, columns, targets)
    known = cells.where(F.col("value").isNotNull())
    ends = cut_lineage(
        known.groupBy(*BY).agg(F.min("value").alias("__min"), F.max("value").alias("__max"))
    )
    width = (F.col("__max") - F.col("__min")) / bins
    place = F.when(F.col("__max") == F.col("__min"), 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("__min")) / width), F.lit(bins - 1))
    )
    sums = [
        (F.sum(f"{t}__sum") / F.nullif(F.sum(f"{t}__n"), F.lit(0))).alias(f"{t}_mean")
        for t in dict.fromkeys(targets)
    ]
    return (
        attach(known, ends, BY, ["__min", "__max"])
        .withColumn("bin", place.cast("int"))
        .groupBy(*BY, "bin", "__min", "__max")
        .agg(F.sum("n").alias("count"), *sums)
        .withColumn("low", F.col("__min") + F.col("bin") * width)
        .withColumn("high", F.col("__min") + (F.col("bin") + 1) * width)
        .drop("__min", "__max")
    )

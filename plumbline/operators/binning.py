"""Numeric binning: fit edges on one table, apply them to any table.

Edges are a one-row aggregate. Applying them is a compiled expression inside the
scan stage: no join, no shuffle. Bins are right-closed, numbered from 1, and the
lowest edge belongs to the first bin.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.arrays import count_below
from plumbline.functions.columns import number, share
from plumbline.functions.frames import pin_row
from plumbline.operators.quantiles import quantiles

INFINITY = float("inf")


@dataclass(frozen=True)
class Bins:
    """Ascending edges in a one-row table, and an upper bound on how many there are."""

    edges: DataFrame
    max_edges: int

    def assign(self, df: DataFrame, column: str, out: str = "bin_id") -> DataFrame:
        """Add the bin number; NULL for NULL, NaN and values outside the edges."""
        value, below, edges = F.col("__x"), F.col("__below"), F.col("__edges")
        bin_id = F.when(value == F.get(edges, F.lit(0)), F.lit(1)).when(
            (below > 0) & (below < F.size(edges)), below
        )
        return (
            df.withColumns({"__edges": self.edges.scalar(), "__x": number(column)})
            .withColumn("__below", count_below(edges, value, self.max_edges))
            .withColumn(out, bin_id.cast("int"))
            .drop("__edges", "__x", "__below")
        )

    def label(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """Add the interval text, e.g. ``(1.0, 18.0]``."""
        binned = self.assign(df, column, "__bin_id").withColumn(
            "__edges", self.edges.scalar()
        )
        position = F.col("__bin_id")
        text = F.concat(
            F.lit("("),
            F.get("__edges", position - 1).cast("string"),
            F.lit(", "),
            F.get("__edges", position).cast("string"),
            F.lit("]"),
        )
        return binned.withColumn(out, text).drop("__bin_id", "__edges")

    def table(self) -> DataFrame:
        """``bin_id, lo, hi``, one row per bin."""
        spans = F.transform(
            F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 1, F.lit(0))),
            lambda hi, i: F.struct(
                (i + 1).alias("bin_id"), F.get("edges", i).alias("lo"), hi.alias("hi")
            ),
        )
        return self.edges.select(F.inline(spans))


def quantile_bins(
    df: DataFrame,
    column: str,
    bins: int = 10,
    open_low: bool = True,
    open_high: bool = True,
    digits: int | None = None,
    method: str = "exact",
) -> Bins:
    """Edges at the 0, 1/bins, ... 1 quantiles, repeats dropped, open ends added.

    With the open low end the first bin holds only rows equal to the minimum and
    the last bin is empty on the fitted table; drift numbers depend on that.
    ``digits`` rounds the edges.
    """
    probs = [i / bins for i in range(bins + 1)]
    fitted = quantiles(df, column, probs, method=method, out="edges")
    edge = F.col("edges")
    if digits is not None:
        edge = F.transform(edge, lambda e: F.round(e, digits))
    edge = F.array_distinct(F.filter(edge, lambda e: e.isNotNull()))
    low = [F.array(F.lit(-INFINITY))] if open_low else []
    high = [F.array(F.lit(INFINITY))] if open_high else []
    return _bins(fitted.select(F.concat(*low, edge, *high).alias("edges")), bins + 3)


def equal_width_bins(df: DataFrame, column: str, bins: int = 10) -> Bins:
    """``bins`` equal bins over [min, max]; the lowest edge moves down by 0.1 % of the range."""
    value = number(column)
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    # A constant column gets a range of 0.1 % of the value on either side.
    pad = F.when(lo != hi, F.lit(0.0)).otherwise(
        F.when(lo == 0, F.lit(0.001)).otherwise(F.abs(lo) * 0.001)
    )
    nudge = F.when(lo != hi, (hi - lo) * 0.001).otherwise(F.lit(0.0))
    edges = F.concat(
        F.array(lo - pad - nudge), _evenly(lo - pad, hi + pad, bins)
    )
    return _bins(ends.select(edges.alias("edges")), bins + 1)


def clipped_width_bins(
    df: DataFrame,
    column: str,
    bins: int = 10,
    digits: int | None = None,
    method: str = "exact",
) -> Bins:
    """Equal widths between the 5 % and 95 % quantiles, with open ends."""
    fitted = quantiles(df, column, [0.05, 0.95], method=method, out="edges")
    lo, hi = F.get("edges", F.lit(0)), F.get("edges", F.lit(1))
    inner = F.concat(F.array(lo), _evenly(lo, hi, bins - 1))
    if digits is not None:
        inner = F.transform(inner, lambda e: F.round(e, digits))
    edges = F.concat(
        F.array(F.lit(-INFINITY)), F.array_distinct(inner), F.array(F.lit(INFINITY))
    )
    return _bins(fitted.select(edges.alias("edges")), bins + 2)


def user_bins(spark: SparkSession, edges: Sequence[float]) -> Bins:
    values = sorted({float(e) for e in edges})
    frame = spark.range(1, numPartitions=1).select(
        F.array(*[F.lit(v) for v in values]).alias("edges")
    )
    return Bins(frame, len(values))


def histogram(
    df: DataFrame, column: str, bins: Bins, targets: Sequence[str] = ()
) -> DataFrame:
    """Per bin its edges, count, share and the mean of each target.

    Empty bins are kept with count 0 and mean 0. A row with NULL ``bin_id`` holds
    the values without a bin, if there are any.
    """
    targets = list(dict.fromkeys(targets))
    rows = bins.assign(df, column, "bin_id").select(
        "bin_id", F.lit(1).alias("weight"), *targets
    )
    # Zero-weight rows, one per bin, keep empty bins in the result.
    every_bin = bins.table().select("bin_id", F.lit(0).alias("weight"))
    counts = (
        rows.unionByName(every_bin, allowMissingColumns=True)
        .groupBy("bin_id")
        .agg(
            F.sum("weight").alias("count"),
            *[F.coalesce(F.avg(t), F.lit(0.0)).alias(f"{t}_mean") for t in targets],
        )
    )
    total = counts.agg(F.sum("count"))
    return (
        counts.withColumn("__edges", bins.edges.scalar())
        .withColumn("lo", F.get("__edges", F.col("bin_id") - 1))
        .withColumn("hi", F.get("__edges", F.col("bin_id")))
        .withColumn("share", share(F.col("count"), total.scalar()))
        .select(
            "bin_id", "lo", "hi", "count", "share", *[f"{t}_mean" for t in targets]
        )
    )


def _bins(edges: DataFrame, max_edges: int) -> Bins:
    return Bins(pin_row(edges), max_edges)


def _evenly(lo: Column, hi: Column, steps: int) -> Column:
    """The ends of ``steps`` equal spans from ``lo`` to ``hi``."""
    width = (hi - lo) / steps
    return F.transform(
        F.sequence(F.lit(1), F.lit(steps)),
        lambda i: F.when(i == steps, hi).otherwise(lo + i * width),
    )

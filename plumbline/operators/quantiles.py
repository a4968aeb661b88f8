"""Quantiles with linear interpolation, overall or per group.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer,
and a sketch per task of one group meets in one task. Here values are counted first,
the counts get their running total within the group by ranges of the sort order
(:mod:`plumbline.operators.ordering`), and the rows that hold a wanted rank are
picked. A group of any size is spread over as many tasks as it fills, and the result
is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import number
from plumbline.functions.frames import attach, pin
from plumbline.operators.ordering import running_total

SKETCH_ACCURACY = 50_000


def quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    method: str = "exact",
    extra: Mapping[str, Column] | None = None,
    out: str = "quantiles",
) -> DataFrame:
    """``by`` columns, the ``extra`` aggregates and an array with one quantile per prob.

    ``method="approx"`` takes one pass with a mergeable sketch per group, rank error
    below 1 / 50,000. Without ``by`` the result is one row, also for an empty input.

    For the exact method ``df`` is read twice when the function is called: by the
    aggregates, and by the count of each value, which is stored.
    """
    by = list(by)
    extra = dict(extra or {})
    if method == "approx":
        sketch = F.percentile_approx(
            number(column), _literals(probs), SKETCH_ACCURACY
        ).alias(out)
        return df.groupBy(*by).agg(*_named(extra), sketch)
    if method != "exact":
        raise ValueError(f"unknown quantile method: {method}")

    summary = pin(
        df.groupBy(*by)
        .agg(*_named(extra), F.count(number(column)).alias("__n"))
        .withColumn("__ranks", _ranks(probs)),
        by,
    )
    counted = (
        df.select(*by, number(column).alias("__x"))
        .where(F.col("__x").isNotNull())
        .groupBy(*by, "__x")
        .agg(F.count(F.lit(1)).alias("__same"))
    )
    placed = running_total(counted, [F.col("__x")], by, F.col("__same"), out="__end")
    picked = (
        attach(placed, summary.select(*by, "__ranks"), by, ["__ranks"])
        .where(
            F.exists(
                "__ranks",
                lambda r: _inside(r["low"], F.col("__end") - F.col("__same"), F.col("__end"))
                | _inside(r["high"], F.col("__end") - F.col("__same"), F.col("__end")),
            )
        )
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct("__end", "__x"))).alias("__picked"))
    )
    names = [*by, *extra]
    finished = attach(
        summary.select(*names, "__ranks"), picked, by, ["__picked"]
    ).withColumn(out, F.transform("__ranks", _interpolated))
    return finished.select(*names, out)


def quantile_columns(
    df: DataFrame, names: Mapping[str, float], source: str = "quantiles"
) -> DataFrame:
    """Spread a quantile array computed for ``names.values()`` into named columns."""
    return df.withColumns(
        {name: F.get(source, F.lit(i)) for i, name in enumerate(names)}
    ).drop(source)


def _named(columns: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def _literals(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _ranks(probs: Sequence[float]) -> Column:
    """Neighbouring 0-based ranks of each quantile and the weight of the upper one."""
    last = F.col("__n") - 1

    def rank(prob: float) -> Column:
        exact = last * F.lit(float(prob))
        # (n - 1) * 0.3 can miss a whole number by one bit; take the whole number.
        nearest = F.round(exact)
        position = F.when(F.abs(exact - nearest) < 1e-6, nearest).otherwise(exact)
        return F.struct(
            F.floor(position).cast("long").alias("low"),
            F.ceil(position).cast("long").alias("high"),
            (position - F.floor(position)).alias("weight"),
        )

    return F.array(*[rank(p) for p in probs])


def _inside(rank: Column, start: Column, end: Column) -> Column:
    return (start <= rank) & (rank < end)


def _interpolated(rank: Column) -> Column:
    def value_at(position: Column) -> Column:
        return F.get(
            F.filter("__picked", lambda p: p["__end"] > position), F.lit(0)
        )["__x"]

    low, high = value_at(rank["low"]), value_at(rank["high"])
    return F.when(rank["low"] >= 0, low + (high - low) * rank["weight"])

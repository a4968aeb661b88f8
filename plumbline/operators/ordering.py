"""Exact running numbers over data of any size and any skew.

A window without partition keys puts the whole table in one task, and a window
partitioned by a hot key puts that key in one task. Here the sort order itself is
cut into ranges, so one key may span many of them:

1. rows are range-partitioned by (group, order) into as many ranges as their number
   asks for, and stored with the number of their range,
2. one small aggregate gives, per range, its first and last group and the weight
   that runs over its end,
3. rows are numbered inside (range, group) and the carried weight, from a table of
   one row per range, is added.

Rows that are only numbered are stored in their order with their place in it, so that
the columns they were sorted by need not be kept.

Step 1 runs when the function is called: the input is stored once, so it is computed
once, then sampled and ranged from there. Steps 2 and 3 are lazy. There is one path
for every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.state import cut_lineage

ROWS_PER_BLOCK = 250_000
MIN_BLOCKS = 4
#: Numbers that ``monotonically_increasing_id`` has for the rows of one partition.
PLACES = 1 << 33


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    weight: Column | None = None,
    out: str = "position",
    blocks: int | None = None,
) -> DataFrame:
    """Running sum of ``weight`` (default 1) in ``order`` inside each ``by`` group.

    ``order`` is ascending with NULLs last; negate a number to sort it the other
    way. Together with ``by`` it must identify a row, or ties are numbered in
    any order.
    """
    rows = ranged(df, order, by, weight, blocks)
    return _number(rows, order, by, out, grouped=bool(by)).select(*df.columns, out)


def row_numbers(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str],
    within: str,
    overall: str | None = None,
    blocks: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """1-based number inside each ``by`` group and, optionally, a 0-based number
    over the whole table sorted by (``by``, ``order``). Both come from one shuffle.

    ``keep`` names the columns to return, if not all: the others are not moved again.
    """
    kept = list(df.columns if keep is None else keep)
    cut = _cut(df, order, by, None, blocks).sortWithinPartitions(*_sort_keys(order, by))
    # In sorted rows this number has the place inside the range in its lower bits.
    placed = cut.withColumn("__at", F.monotonically_increasing_id())
    stored = cut_lineage(placed.select(*dict.fromkeys([*by, *kept]), "__weight", "__block", "__at"))
    rows, order = stored, [F.col("__at")]
    outs = [F.col(within)]
    if overall:
        place = F.col("__at").bitwiseAND(F.lit(PLACES - 1)) + 1
        rows = _number(rows, order, by, overall, False, local=place)
        outs.append((F.col(overall) - 1).alias(overall))
    rows = _number(rows, order, by, within, True, stored)
    return rows.select(*kept, *outs)


def ranged(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str],
    weight: Column | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Stored rows with ``__weight`` and the number ``__block`` of their range."""
    return cut_lineage(_cut(df, order, by, weight, blocks))


def _cut(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str],
    weight: Column | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Rows, from a stored copy, dealt to ranges with the number ``__block`` of theirs."""
    weighted = (F.lit(1) if weight is None else weight).cast("long")
    rows = cut_lineage(df.withColumn("__weight", weighted))
    blocks = blocks or max(MIN_BLOCKS, -(-rows.count() // ROWS_PER_BLOCK))
    cut = rows.repartitionByRange(blocks, *_sort_keys(order, by))
    return cut.withColumn("__block", F.spark_partition_id())


def _sort_keys(order: Sequence[Column], by: Sequence[str]) -> list[Column]:
    keys = [F.col(c).asc_nulls_first() for c in by] + [c.asc_nulls_last() for c in order]
    if not keys:
        raise ValueError("an order is needed")
    return keys


def _carried(rows: DataFrame, by: Sequence[str], grouped: bool) -> DataFrame:
    """One row per range: ``__first``, its first group, and the weight it inherits."""
    group = F.struct(F.lit(0).alias("g"), *[F.col(c) for c in by if grouped])
    sums = (
        rows.select("__block", group.alias("__group"), "__weight")
        .groupBy("__block", "__group")
        .agg(F.sum("__weight").alias("w"))
    )
    ends = sums.groupBy("__block").agg(
        F.min("__group").alias("__first"), F.max(F.struct("__group", "w")).alias("last")
    )
    # As many rows as there are ranges. A group's ranges follow each other, so what a
    # range inherits is all that earlier ranges ending with that group hold of it.
    before = Window.partitionBy("last.__group").orderBy("__block")
    summed = ends.withColumn(
        "run", F.sum("last.w").over(before.rowsBetween(Window.unboundedPreceding, 0))
    )
    previous = F.lag(F.struct(F.col("last.__group").alias("group"), "run")).over(
        Window.orderBy("__block")
    )
    tagged = summed.withColumn("previous", previous)
    same = F.col("previous.group") == F.col("__first")
    return tagged.select(
        "__block", "__first", F.when(same, F.col("previous.run")).otherwise(0).alias("__carry")
    )


def _number(
    rows: DataFrame,
    order: Sequence[Column],
    by: Sequence[str],
    out: str,
    grouped: bool,
    stored: DataFrame | None = None,
    local: Column | None = None,
) -> DataFrame:
    """``rows`` numbered; ``stored``, if given, has the same ranges, and ``local`` is the
    number inside (range, group), if known."""
    keys = [F.col(c) for c in by]
    within = keys if grouped else []
    sort = ([] if grouped else keys) + [c.asc_nulls_last() for c in order]
    if local is None:
        local = F.sum("__weight").over(
            Window.partitionBy("__block", *within)
            .orderBy(*sort)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
    group = F.struct(F.lit(0).alias("g"), *within)
    carried = _carried(rows if stored is None else stored, by, grouped)
    # A row per range: broadcast, the join moves no rows and keeps the order of a range's.
    joined = rows.join(F.broadcast(carried), "__block").withColumn(out, local)
    carry = F.when(F.col("__first") == group, F.col("__carry")).otherwise(F.lit(0))
    return joined.withColumn(out, F.col(out) + carry).drop("__first", "__carry")

"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    A lambda that captures an expression computes it again for each item, however the
    plan is cut. As the item of an array it is a variable instead.
    """
    return F.get(F.transform(F.array(value), lambda bound: use(bound)), F.lit(0))


#: Number of states that :func:`states` gathers before it puts them aside.
PART = 256


def states(
    items: Column, first: Column, step: Callable[[Column, Column], Column]
) -> Column:
    """``first`` and the state after each item, as an array one longer than ``items``.

    Appending copies what is there, so states are gathered in parts of ``PART`` and only
    whole parts are appended to the rest. A state must not be NULL.
    """
    none = F.slice(F.array(F.array(first)), 1, 0)

    def walk(s: Column, x: Column) -> Column:
        now, room = step(F.element_at(s["part"], -1), x), F.size(s["part"]) < PART
        return F.struct(
            F.when(room, s["whole"]).otherwise(F.array_append(s["whole"], s["part"])).alias("whole"),
            F.when(room, F.array_append(s["part"], now)).otherwise(F.array(now)).alias("part"),
        )

    return F.aggregate(
        items,
        F.struct(none.alias("whole"), F.array(first).alias("part")),
        walk,
        lambda s: F.flatten(F.array_append(s["whole"], s["part"])),
    )

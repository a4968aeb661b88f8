"""Searching and drawing inside arrays, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def count_below(ordered: Column, value: Column, max_size: int) -> Column:
    """How many items of an ascending array of at most ``max_size`` are below ``value``.

    One compiled comparison per item. A longer array is an error, not a wrong count.
    """
    terms = [
        F.when(F.get(ordered, F.lit(i)) < value, F.lit(1)).otherwise(F.lit(0))
        for i in range(max(1, max_size))
    ]
    too_long = F.raise_error(F.lit(f"array has more than {max_size} items")).cast("int")
    return F.when(F.size(ordered) > max_size, too_long).otherwise(sum(terms[1:], terms[0]))

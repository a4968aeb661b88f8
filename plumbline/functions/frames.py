"""Small helpers for attaching aggregates back to the rows they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from plumbline.sources.state import cut_lineage


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which NULL keys match; the right-hand keys are dropped.

    ``<=>`` is still a hashable key for Spark, so the optimizer is free to pick
    broadcast-hash or sort-merge from the real sizes.
    """
    names = {k: f"__right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(names)
    condition = None
    for key in keys:
        term = left[key].eqNullSafe(renamed[names[key]])
        condition = term if condition is None else condition & term
    joined = left.join(renamed, condition, how)
    return joined.drop(*names.values())


def attach(
    df: DataFrame, small: DataFrame, by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Put per-group columns of ``small`` on every row of ``df``.

    Without groups ``small`` is a one-row aggregate and travels as a scalar
    subquery, so no join and no shuffle of ``df`` is needed.
    """
    if by:
        return null_safe_join(df, small.select(*by, *columns), by)
    return df.withColumns({c: small.select(c).scalar() for c in columns})


def pin_row(df: DataFrame) -> DataFrame:
    """Compute an aggregate that has one row by design, and carry it as a local table."""
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)


def pin(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Compute an aggregate now, so that plans that build on it stay short.

    With groups it is stored, whatever its size; without, it is one row.
    """
    return cut_lineage(df) if by else pin_row(df)


def one_row(df: DataFrame, **columns: Column) -> DataFrame:
    """A one-row frame in the session of ``df``."""
    row = df.sparkSession.range(1, numPartitions=1)
    return row.select(*[c.alias(n) for n, c in columns.items()])


def metric_columns_in_order(df: DataFrame, key: str, prefixes: Sequence[str]) -> DataFrame:
    """Order prefixed columns by metric name so that compared models sit together."""

    def metric(name: str) -> str:
        for prefix in prefixes:
            if name.startswith(prefix):
                return name[len(prefix) :]
        return name

    rest = sorted((c for c in df.columns if c != key), key=lambda c: (metric(c), c))
    return df.select(key, *rest)


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def first_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order, so that the choice is repeatable."""
    return df.orderBy(*keys).limit(n)


#: Rows that one task gets at most, on average, where their number is known.
TASK_ROWS = 2_000_000


def dealt(df: DataFrame, size: int, *columns: str, always: bool = False) -> DataFrame:
    """``df`` dealt by ``columns`` to as many tasks as its ``size`` rows ask for.

    Where the session's shuffle partitions are enough of them, Spark deals as it does, when
    it has to, or here if ``always``.
    """
    tasks = -(-size // TASK_ROWS)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(tasks, *columns)
    return df.repartition(*columns) if always else df

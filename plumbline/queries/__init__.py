"""Every operator as a named query over the driver tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.queries import (
    drift,
    interactions,
    jobs,
    listwise,
    models,
    profile,
    ranking,
    wide,
)

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (profile, drift, interactions, ranking, jobs, models, listwise, wide)


def all_queries() -> dict[str, Query]:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}

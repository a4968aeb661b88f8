"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app: str = "plumbline", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with adaptive execution on and timestamps read as UTC.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

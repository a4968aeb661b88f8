"""Fitted state as one Parquet table per item under one folder, and lineage cuts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SETTINGS = "settings"
#: Stored copies are read a few times and dropped: a third smaller than Spark's usual codec.
SMALLER = {"compression": "zstd"}
READ_BYTES = "spark.sql.files.maxPartitionBytes"
_open_scratch: list[str] = []


def save_state(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], settings: str = "{}"
) -> None:
    """Write the tables and the settings text."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
    frame = spark.createDataFrame([(settings,)], "settings STRING")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{SETTINGS}")


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def load_settings(spark: SparkSession, folder: str) -> dict[str, Any]:
    return json.loads(spark.read.parquet(f"{folder}/{SETTINGS}").first()["settings"])


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stored"


def working_folder(spark: SparkSession) -> str:
    """Where stored copies go: the innermost open :func:`scratch`, or the shared folder."""
    return _open_scratch[-1] if _open_scratch else shared_folder(spark)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """A stored copy of ``df`` in the shared folder, so that passes over it start there.

    ``group_bytes`` is the size of its row groups, the least that :func:`small_reads` gives
    to a task; where not given it is Parquet's own, and the copy is as small as it can be.
    """
    path = f"{working_folder(df.sparkSession)}/plumbline-{uuid.uuid4().hex}"
    # Small reads go by stored bytes, so that these bound the rows of a task.
    options = SMALLER if group_bytes is None else {"parquet.block.size": group_bytes}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_reads(spark: SparkSession, most: int) -> Iterator[None]:
    """Inside, a task reads at most ``most`` bytes of a stored table, or one row group."""
    usual = spark.conf.get(READ_BYTES)
    spark.conf.set(READ_BYTES, f"{most}b")
    try:
        yield
    finally:
        spark.conf.set(READ_BYTES, usual)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Stored copies made inside are deleted at the end: write the results before that."""
    folder = f"{shared_folder(spark)}/plumbline-{uuid.uuid4().hex}"
    _open_scratch.append(folder)
    try:
        yield
    finally:
        _open_scratch.remove(folder)
        delete(spark, folder)

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from plumbline import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "plumbline-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def users_df(spark):
    """6,040 users: 4,331 ``M`` and 1,709 ``F``."""
    return spark.range(6040).selectExpr(
        "id AS user_id",
        "CASE WHEN id < 4331 THEN 'M' ELSE 'F' END AS gender",
        "CAST(18 + id % 47 AS INT) AS age",
        "CAST(id % 2 AS INT) AS target",
        "lpad(CAST(1 + id % 5 AS STRING), 2, '0') AS year_month",
    )


def rows(df, *columns):
    """Result rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)

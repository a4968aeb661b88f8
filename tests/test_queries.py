"""Every registered query against its SQL twin on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as registry
from check_queries import TABLES, _normal
from plumbline.queries import all_queries, all_sql, models


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_registry_is_consistent():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    queries, sql = all_queries(), all_sql()
    assert set(queries) - set(sql) == set(models.QUERIES), "only model fits go without SQL"


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["user_id", "item_id", "segment", "brand", "pred", "rank"]
    assert df.count() == 3 * 150


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = registry.queries()[name](spark, SF_DIR)
    result = db.sql(registry.oracle_sql()[name])
    expected = _normal(result.columns, result.fetchall())
    assert _normal(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_model_query(spark):
    curve = registry.queries()["learning_curve"](spark, SF_DIR)
    losses = [r["train_loss"] for r in curve.orderBy("iteration").collect()]
    assert len(losses) == 3 and losses == sorted(losses, reverse=True)

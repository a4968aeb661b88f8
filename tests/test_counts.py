from __future__ import annotations

import pytest
from conftest import rows

from plumbline.operators import counts


def test_value_counts_golden(users_df):
    assert rows(counts.value_counts(users_df, "gender")) == [
        ("gender", "F", 1709, 0.28294701986754967),
        ("gender", "M", 4331, 0.7170529801324503),
        ("gender", "missing", 0, 0.0),
        ("gender", "total", 6040, 1.0),
    ]


def test_value_counts_sorted(users_df):
    table = counts.value_counts(users_df, "gender", sort_by="count").collect()
    assert [r["value"] for r in table] == ["total", "M", "F", "missing"]


def test_missing_row_holds_null_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c STRING")
    table = {r["value"]: r for r in counts.value_counts(df, "c").collect()}
    assert table["missing"]["count"] == 1 and table["total"]["count"] == 4
    shares = [r["proportion"] for v, r in table.items() if v != "total"]
    assert sum(shares) == pytest.approx(1.0)


def test_value_counts_of_empty_table(spark):
    df = spark.createDataFrame([], "c STRING")
    assert rows(counts.value_counts(df, "c")) == [
        ("c", "missing", 0, None),
        ("c", "total", 0, None),
    ]


def test_counts_with_total_keeps_null_group(spark):
    df = spark.createDataFrame([("a",), (None,)], "c STRING")
    assert rows(counts.value_counts_with_total(df, "c")) == [
        ("a", 1, 0.5),
        ("total", 2, 1.0),
        (None, 1, 0.5),
    ]


def test_counts_within_groups(spark):
    df = spark.createDataFrame([("x", 1), ("x", 0), ("y", 1)], "s STRING, label INT")
    assert rows(counts.value_counts_within(df, "label", "s")) == [
        ("x", "0", 1, 0.5),
        ("x", "1", 1, 0.5),
        ("x", "total", 2, 1.0),
        ("y", "1", 1, 1.0),
        ("y", "total", 1, 1.0),
    ]


def test_stats_by_value(users_df):
    table = counts.stats_by_value(users_df, "gender", "target")
    assert table.columns == ["gender", "count", "proportion", "target"]
    found = {r["gender"]: r for r in table.collect()}
    assert found["F"]["count"] == 1709
    assert found["M"]["proportion"] == 0.7170529801324503
    assert found["M"]["target"] == pytest.approx(2165 / 4331)
    assert counts.stats_by_value(users_df, "gender").columns == [
        "gender",
        "count",
        "proportion",
    ]


def test_unit_target_is_dropped_on_request(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "c STRING, t INT")
    assert "target" in counts.stats_by_value(df, "c", "t").columns
    assert "target" not in counts.stats_by_value(df, "c", "t", drop_unit_target=True).columns


def test_stats_over_time(users_df):
    table = counts.stats_over_time(users_df, "gender", "year_month")
    assert table.columns == ["year_month", "gender", "count", "proportion"]
    sums = table.groupBy("year_month").sum("proportion").collect()
    assert len(sums) == 5 and all(r[1] == pytest.approx(1.0) for r in sums)


def test_null_time_bucket_keeps_its_share(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("1", "a")], "t STRING, c STRING")
    assert rows(counts.stats_over_time(df, "c", "t")) == [
        ("1", "a", 1, 1.0),
        (None, "a", 1, 0.5),
        (None, "b", 1, 0.5),
    ]


def test_group_rare_and_histogram(spark):
    values = ["a"] * 4 + ["b"] * 3 + ["c"] * 2 + ["d"] + [None] * 5
    df = spark.createDataFrame([(v, 1) for v in values], "c STRING, t INT")
    assert rows(counts.category_histogram(df, "c", 2, ["t"])) == [
        ("Others", 3, 1.0, 0.2),
        ("a", 4, 1.0, 4 / 15),
        ("b", 3, 1.0, 0.2),
        ("missing", 5, 1.0, 1 / 3),
    ]
    assert [r["value"] for r in counts.top_categories(df, "c", 2, 2).collect()] == [
        "missing",
        "a",
    ]


def test_category_shares_let_null_compete(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "c STRING")
    assert rows(counts.category_shares(df, "c", 1)) == [("Others", 0.5), ("missing", 0.5)]
    assert rows(counts.category_shares(df, "c", 9)) == [
        ("Others", 0.0),
        ("a", 0.25),
        ("b", 0.25),
        ("missing", 0.5),
    ]

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plumbline.functions.arrays import count_below
from plumbline.functions.frames import pin
from plumbline.operators import binning, summaries
from plumbline.operators.quantiles import quantiles

REPEATS = [1.0, 18.0, 18.0, 25.0, 25.0, 25.0, 35.0, 35.0, 45.0, 50.0, 56.0, 56.0]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x DOUBLE")


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    probs = [0, 0.05, 0.1, 0.25, 0.3, 0.5, 0.75, 0.9, 1]
    got = quantiles(frame(spark, [float(v) for v in values]), "x", probs).first()[0]
    assert got == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-9)


def test_quantiles_on_many_rows_and_groups(spark):
    rng = random.Random(3)
    # One group holds most rows and one value a third of them.
    data = [
        ("hot" if i % 4 else None, 7.0 if i % 3 == 0 else rng.lognormvariate(0, 2))
        for i in range(60_000)
    ]
    df = spark.createDataFrame(pd.DataFrame(data, columns=["g", "x"]), "g STRING, x DOUBLE")
    probs = [0.1, 0.25, 0.5, 0.75, 0.999]
    got = {r["g"]: r["quantiles"] for r in quantiles(df, "x", probs, ["g"]).collect()}
    for key in ("hot", None):
        expected = np.quantile([x for g, x in data if g == key], probs)
        assert got[key] == pytest.approx(expected.tolist(), rel=1e-12)


def test_quantiles_of_many_groups(spark):
    df = spark.range(3000).selectExpr("id % 40 AS g", "CAST(id * id % 977 AS DOUBLE) AS x")
    got = {r["g"]: r["quantiles"] for r in quantiles(df, "x", [0.1, 0.5, 1.0], ["g"]).collect()}
    for g in range(40):
        own = [i * i % 977 for i in range(g, 3000, 40)]
        assert got[g] == pytest.approx(np.quantile(own, [0.1, 0.5, 1.0]).tolist())
    assert rows(quantiles(df, "x", [0.5])) == [([float(np.median(_squares()))],)]


def _squares():
    return [i * i % 977 for i in range(3000)]


def test_many_edges(spark):
    df = spark.range(500).selectExpr("CAST(id AS DOUBLE) / 2 AS x")
    fine = binning.user_bins(spark, range(0, 201))
    coarse = [r["bin_id"] for r in fine.assign(df, "x").orderBy("x").collect()]
    expected = pd.cut(np.arange(500) / 2, list(range(201)), include_lowest=True).codes + 1
    assert [b or 0 for b in coarse] == expected.tolist()


def test_pin_stores_groups_and_keeps_one_row_local(spark):
    df = spark.range(3)
    assert "LocalTableScan" in pin(df.groupBy().count(), [])._jdf.queryExecution().toString()
    stored = pin(df.groupBy("id").count(), ["id"])
    assert "plumbline-" in stored.inputFiles()[0] and stored.count() == 3


def test_an_array_longer_than_told_is_an_error(spark):
    df = spark.range(1).select(count_below(F.array(F.lit(1), F.lit(2)), F.lit(3), 1).alias("n"))
    with pytest.raises(Exception, match="more than 1"):
        df.collect()


def test_quantiles_ignore_null_and_nan(spark):
    assert quantiles(frame(spark, [1.0, None, float("nan"), 3.0]), "x", [0.5]).first()[0] == [2.0]
    assert quantiles(frame(spark, []), "x", [0.5]).first()[0] == [None]


def test_approximate_quantiles(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS x")
    assert quantiles(df, "x", [0.5], method="approx").first()[0] == [500.0]
    with pytest.raises(ValueError):
        quantiles(df, "x", [0.5], method="other")


def test_quantile_bins_of_repeated_values(spark):
    df = frame(spark, [*REPEATS, None])
    bins = binning.quantile_bins(df, "x", digits=9)
    edges = bins.edges.first()["edges"]
    assert edges[1:-1] == [1.0, 18.0, 19.4, 25.0, 30.0, 35.0, 42.0, 49.0, 55.4, 56.0]
    assert edges[0] == -np.inf and edges[-1] == np.inf
    table = {r["bin_id"]: r["count"] for r in binning.histogram(df, "x", bins).collect()}
    assert table[1] == 1, "the first bin holds only the minimum"
    assert table[11] == 0, "the last bin is empty on the fitted table"
    assert table[None] == 1
    assert sum(table.values()) == 13


def test_bins_match_pandas(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=500).round(2)
    df = frame(spark, values.tolist())
    _, breaks = pd.qcut(pd.Series(values), q=10, retbins=True, duplicates="drop")
    cut = pd.cut(values, [-np.inf, *breaks, np.inf], include_lowest=True)
    expected = sorted(zip(values.tolist(), (cut.codes + 1).tolist(), strict=True))
    got = binning.quantile_bins(df, "x").assign(df, "x").collect()
    assert sorted(tuple(r) for r in got) == expected


def test_equal_width_matches_pandas(spark):
    values = [0.0, 1.0, 2.5, 3.0, 7.0, 10.0]
    _, breaks = pd.cut(pd.Series(values), bins=4, retbins=True, include_lowest=True)
    bins = binning.equal_width_bins(frame(spark, values), "x", 4)
    assert bins.edges.first()["edges"] == pytest.approx(breaks.tolist())
    constant = binning.equal_width_bins(frame(spark, [7.0, 7.0]), "x", 2)
    _, breaks = pd.cut(pd.Series([7.0, 7.0]), bins=2, retbins=True, include_lowest=True)
    assert constant.edges.first()["edges"] == pytest.approx(breaks.tolist())


def test_one_value_degrades(spark):
    df = frame(spark, [7.0, 7.0, 7.0])
    table = binning.histogram(df, "x", binning.quantile_bins(df, "x"))
    assert rows(table, "bin_id", "count") == [(1, 3), (2, 0)]


def test_edges_of_one_table_on_another(spark):
    bins = binning.user_bins(spark, [0, 10, 20])
    df = frame(spark, [0.0, 0.1, 10.0, 10.1, 20.0, 20.1, -1.0, None])
    got = [r["bin_id"] for r in bins.assign(df, "x").collect()]
    assert got == [1, 1, 1, 2, 2, None, None, None]
    assert rows(bins.table()) == [(1, 0.0, 10.0), (2, 10.0, 20.0)]


def test_interval_labels(spark):
    df = frame(spark, [0.0, 15.0, None])
    labels = [r["l"] for r in binning.user_bins(spark, [0, 10, 20]).label(df, "x", "l").collect()]
    assert labels == ["(0.0, 10.0]", "(10.0, 20.0]", None]


def test_empty_bins_have_zero_means(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (25.0, 1)], "x DOUBLE, t INT")
    table = binning.histogram(df, "x", binning.user_bins(spark, [0, 10, 20, 30]), ["t", "t"])
    assert rows(table, "bin_id", "count", "t_mean") == [(1, 2, 0.5), (2, 0, 0.0), (3, 1, 1.0)]


def test_clipped_width(spark):
    df = spark.range(101).selectExpr("CAST(id AS DOUBLE) AS x")
    edges = binning.clipped_width_bins(df, "x", 4, digits=9).edges.first()["edges"]
    assert edges == [-np.inf, 5.0, 35.0, 65.0, 95.0, np.inf]


def test_numeric_summary(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 1), (None, 1)], "x DOUBLE, t INT")
    got = summaries.numeric_summary(df, "x", ["t"]).first().asDict()
    assert got == pytest.approx(
        {
            "count": 2,
            "missing": 1,
            "mean": 2.0,
            "std": 2**0.5,
            "min": 1.0,
            "max": 3.0,
            "t_mean": 0.5,
            "t_std": 0.5**0.5,
            "q1": 1.5,
            "q2": 2.0,
            "q3": 2.5,
        }
    )


def test_categorical_summary_counts_null_as_category(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "c STRING, t INT")
    got = summaries.categorical_summary(df, "c", ["t"]).first()
    assert (got["categories"], got["total"], got["missing"], got["t_mean"]) == (2, 3, 1, 0.5)


def test_boxplot_and_outliers(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 100.0])
    box = summaries.boxplot_stats(df, "x").first()
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 5.0, 1)
    assert rows(summaries.outliers(df, "x")) == [(100.0,)]


def test_many_columns_from_one_read(spark):
    """The same numbers as column by column, with NULL, NaN, constants and no value at all."""
    from pyspark.sql import functions as F

    from plumbline.operators import summaries, wide

    df = spark.range(500).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 50).cast("int").alias("a"),
        F.when(F.col("id") % 5 > 0, F.sqrt("id")).otherwise(float("nan")).alias("b"),
        F.lit(3).alias("same"),
        F.lit(None).cast("double").alias("none"),
        (F.col("id") % 3).alias("t"),
    )
    columns = ["a", "b", "same", "none"]
    cells = wide.value_cells(df, columns, ["t"])
    got = {r["column"]: r for r in wide.numeric_summaries(df, columns, ["t"], cells).collect()}
    boxes = {r["column"]: r for r in wide.numeric_boxes(df, columns, cells).collect()}
    assert set(got) == set(columns) and set(boxes) == {"a", "b", "same"}
    for c in columns:
        expected = summaries.numeric_summary(df, c, ["t"]).first()
        for name in expected.asDict():
            assert got[c][name] == pytest.approx(expected[name]), (c, name)
        if c in boxes:
            box = summaries.boxplot_stats(df, c).first()
            for name in box.asDict():
                assert boxes[c][name] == pytest.approx(box[name]), (c, name)
    bars = wide.numeric_histograms(df, columns, 4, ["t"], cells)
    assert {r[0]: r[1] for r in bars.groupBy("column").agg(F.sum("count")).collect()} == {
        c: got[c]["count"] for c in ("a", "b", "same")
    }
    assert wide.numeric_summaries(df.limit(0), columns).count() == 0

from __future__ import annotations

import math

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from plumbline.operators import drift


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c STRING")


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x DOUBLE")


def test_equal_distributions_do_not_drift(spark):
    df = numbers(spark, range(100))
    sets = {"train": df, "test": df, "val": df}
    assert [r["psi"] for r in drift.compare_psi("x", **sets).collect()] == pytest.approx([0] * 3)
    assert [r["kl"] for r in drift.compare_kl("x", **sets).collect()] == pytest.approx([0] * 3)


def test_disjoint_categories_stay_finite(spark):
    a, b = texts(spark, ["a"] * 3), texts(spark, ["b"] * 5)
    psi = {r["pair"]: r for r in drift.compare_psi("c", train=a, test=b, val=a).collect()}
    expected = 2 * math.log((1 + 1e-6) / 1e-6)
    assert psi["train_test"]["psi"] == pytest.approx(expected)
    assert psi["train_test"]["severity"] == "significant"
    assert psi["train_val"]["psi"] == pytest.approx(0)
    assert psi["train_val"]["severity"] == "none"
    kl = {r["pair"]: r["kl"] for r in drift.compare_kl("c", train=a, test=b, val=a).collect()}
    assert math.isfinite(kl["train_test"]) and kl["train_test"] > 20


def test_psi_against_plain_arithmetic(spark):
    train = texts(spark, ["a"] * 6 + ["b"] * 4)
    test = texts(spark, ["a"] * 3 + ["b"] * 6 + [None])
    shares = pd.DataFrame({"p": [0.6, 0.4, 0.0], "q": [0.3, 0.6, 0.1]})
    terms = (shares.p - shares.q) * ((shares.p + 1e-6) / (shares.q + 1e-6)).map(math.log)
    table = drift.compare_psi("c", train=train, test=test, val=train)
    got = {r["pair"]: r["psi"] for r in table.collect()}
    assert got["train_test"] == pytest.approx(terms.sum())
    aligned = drift.aligned_category_counts("c", train=train, test=test, val=train)
    single = drift.psi(aligned, "train", "test").first()["psi"]
    assert single == pytest.approx(terms.sum())


def test_top_values_per_set_or_from_train(spark):
    train = texts(spark, ["a"] * 3 + ["b"])
    test = texts(spark, ["b"] * 3 + ["a"])
    own = drift.aligned_category_shares("c", 1, train=train, test=test, val=train)
    assert rows(own, "bin", "train", "test") == [
        ("Others", 0.25, 0.25),
        ("a", 0.75, 0.0),
        ("b", 0.0, 0.75),
    ]
    from_train = drift.aligned_category_shares("c", 1, True, train=train, test=test, val=train)
    assert rows(from_train, "bin", "train", "test") == [("Others", 0.25, 0.75), ("a", 0.75, 0.25)]


def test_values_below_train_minimum_have_no_kl_bin(spark):
    train, test = numbers(spark, range(10, 20)), numbers(spark, [5, 12, 25])
    from plumbline.operators.binning import quantile_bins

    bins = quantile_bins(train, "x", 5, open_low=False, digits=9)
    aligned = drift.aligned_bin_counts("x", bins, train=train, test=test, val=train)
    got = {r["bin"]: r["test"] for r in aligned.collect()}
    assert got[None] == 1 and got[6] == 1


def test_severity_limits(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.2,)], "v DOUBLE")
    got = [r[0] for r in df.select(drift.psi_severity(F.col("v"))).collect()]
    assert got == ["none", "moderate", "significant"]

from __future__ import annotations

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators.features import decode_ids, dense_ids, encode_ids
from plumbline.operators.ordering import row_numbers, running_total


def skewed(spark, n=5000):
    """One user owns more than a third of the rows; some users and times are NULL."""
    return spark.range(n).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 5 < 2, F.lit(7))
        .when(F.col("id") % 97 == 0, F.lit(None))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(50)))
        .alias("user"),
        F.when(F.col("id") % 31 != 0, F.pmod(F.xxhash64("id"), F.lit(40))).alias("ts"),
    )


def test_blocks_agree_with_plain_windows(spark):
    df = skewed(spark)
    order = [-F.col("ts"), F.col("key")]
    got = row_numbers(df, order, ["user"], "rn", "pos", blocks=13)
    plain = [c.asc_nulls_last() for c in order]
    expected = df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("user").orderBy(*plain))
    ).withColumn("pos", F.row_number().over(Window.orderBy("user", *plain)) - 1)
    assert rows(got) == rows(expected)


def test_any_number_of_blocks_gives_the_same(spark):
    df = skewed(spark, 300)
    order = [F.col("ts"), F.col("key")]
    one = row_numbers(df, order, ["user"], "rn", "pos", blocks=1)
    many = row_numbers(df, order, ["user"], "rn", "pos", blocks=5)
    assert rows(one) == rows(many)


def test_running_total_of_weights(spark):
    df = skewed(spark).select("key", "user", (F.col("key") % 3).alias("w"))
    for by in ([], ["user"]):
        got = running_total(df, [F.col("key")], by, F.col("w"), "total", blocks=9)
        window = Window.partitionBy(*by).orderBy("key").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        expected = df.withColumn("total", F.sum("w").over(window))
        assert rows(got) == rows(expected)


def test_hot_group_spans_many_blocks(spark):
    df = spark.range(4000).select("id", F.lit(1).alias("user"))
    got = row_numbers(df, [F.col("id")], ["user"], "rn", blocks=8)
    assert got.where("rn <> id + 1").isEmpty()
    assert "hashpartitioning(__block" in got._jdf.queryExecution().toString()


def test_empty_table(spark):
    df = spark.createDataFrame([], "user INT, key INT")
    assert rows(row_numbers(df, [F.col("key")], ["user"], "rn", "pos", blocks=4)) == []


def test_dense_ids_follow_text_order_and_invert(spark):
    df = spark.createDataFrame([(10,), (9,), (100,), (9,)], "user_id LONG")
    ids = dense_ids(df, "user_id")
    assert rows(ids) == [("10", 1), ("100", 2), ("9", 3)]
    coded = encode_ids(df, "user_id", ids)
    assert rows(coded) == [(1, "10"), (2, "100"), (3, "9"), (3, "9")]
    back = decode_ids(coded.drop("user_id_str"), "user_id", ids, "text")
    assert rows(back) == [(1, "10"), (2, "100"), (3, "9"), (3, "9")]
    unknown = encode_ids(spark.createDataFrame([(5,)], "user_id LONG"), "user_id", ids)
    assert rows(unknown) == [(None, "5")]


def test_both_numbers_come_from_one_sort_of_the_rows(spark):
    data = [(n % 3, n * 7 % 50) for n in range(50)]
    df = spark.createDataFrame(data, "user LONG, ts LONG")
    made = row_numbers(df, [-F.col("ts"), F.col("ts")], ["user"], "within", "overall", blocks=4)
    assert sorted(r["overall"] for r in made.collect()) == list(range(50))
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    sorts = [line for line in plan.splitlines() if " Sort [" in line and "user#" in line.split("]")[0]]
    assert len(sorts) == 1


def test_only_kept_columns_are_moved_again(spark):
    df = skewed(spark, 600).withColumn("wide", F.repeat(F.lit("w"), 50))
    order = [-F.col("ts"), F.col("key"), F.col("wide")]
    whole = row_numbers(df, order, ["user"], "rn", "pos", blocks=5)
    kept = row_numbers(df, order, ["user"], "rn", "pos", blocks=5, keep=["user", "ts"])
    assert kept.columns == ["user", "ts", "rn", "pos"]
    assert rows(kept) == rows(whole, *kept.columns)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "wide" not in plan and "key" not in plan

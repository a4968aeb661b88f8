from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plumbline.operators import interactions as ops
from plumbline.operators.ordering import ranged
from plumbline.operators.encoders import FrequencyEncode, StandardScale
from plumbline.operators.features import join_features
from plumbline.operators.negatives import catalogue, negative_samples, with_negatives


def ratings(spark, pairs):
    df = spark.createDataFrame(pairs, "user_id LONG, movie_id LONG")
    return df.withColumn("qid", F.row_number().over(_by_all()) - 1)


def _by_all():
    from pyspark.sql import Window

    return Window.orderBy("user_id", "movie_id")


def some_ratings(spark):
    pairs = [(u, m) for u in range(12) for m in range(40) if (u * 7 + m * 3) % (u + 2) == 0]
    return ratings(spark, pairs)


def test_tied_timestamps_are_numbered_by_key(spark):
    df = spark.createDataFrame(
        [(1, 3, 9), (1, 1, 9), (1, 2, 9), (2, 5, 1)], "user_id LONG, movie_id LONG, timestamp LONG"
    )
    got = ops.number_interactions(df)
    assert rows(got, "user_id", "movie_id", "interaction_num") == [
        (1, 1, 1),
        (1, 2, 2),
        (1, 3, 3),
        (2, 5, 1),
    ]
    assert rows(got, "qid") == [(0,), (1,), (2,), (3,)]


def test_negatives_are_unseen_distinct_and_complete(spark):
    df = some_ratings(spark)
    negatives = negative_samples(df, k=5)
    assert negatives.count() == 5 * df.count()
    assert negatives.join(df, ["user_id", "movie_id"], "left_semi").isEmpty()
    assert negatives.groupBy("qid", "movie_id").count().where("count > 1").isEmpty()
    assert negatives.where("label <> 0").isEmpty()
    again = negative_samples(df, k=5)
    assert rows(negatives) == rows(again), "same seed, same draws"
    other = negative_samples(df, k=5, seed=1)
    assert rows(negatives) != rows(other)


def test_draws_do_not_depend_on_the_blocks(spark):
    df = some_ratings(spark)
    usual = rows(negative_samples(df, k=5))
    for blocks in (1, 17):
        assert rows(negative_samples(df, k=5, blocks=blocks)) == usual


def test_draws_do_not_depend_on_the_chunks(spark):
    df = some_ratings(spark)
    usual = rows(negative_samples(df, k=5))
    for chunk in (1, 3, 11):
        assert rows(negative_samples(df, k=5, chunk=chunk)) == usual


def test_draws_are_not_sorted_again(spark):
    """Rows of users are stored and sorted before the draws, five times as many, never after."""
    plan = negative_samples(some_ratings(spark), k=5)._jdf.queryExecution().executedPlan().toString()
    drawn = plan.index("Generate")
    assert "Sort" not in plan[:drawn] and "rangepartitioning" not in plan[:drawn]


def test_draws_are_compiled_columns(spark):
    """A lambda over an array would be interpreted step by step for every draw."""
    for chunk in (1024, 3):
        made = negative_samples(some_ratings(spark), k=5, chunk=chunk)
        assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_a_hot_user_is_spread_over_blocks(spark):
    """One user has four fifths of the rows and owns a long run of neighbouring items."""
    df = spark.range(6000).selectExpr(
        "id AS qid",
        "CASE WHEN id % 5 < 4 THEN 1 ELSE id % 40 END AS user_id",
        "CASE WHEN id % 5 < 4 THEN id % 3000 ELSE id END AS movie_id",
    )
    owned = df.where("user_id = 1").select("user_id", "movie_id").distinct()
    sizes = [
        r["count"]
        for r in ranged(owned, [F.col("movie_id")], ["user_id"], blocks=16).groupBy("__block").count().collect()
    ]
    assert len(sizes) > 8 and max(sizes) < 3 * sum(sizes) / len(sizes)
    negatives = negative_samples(df, k=5, blocks=16)
    assert negatives.join(df, ["user_id", "movie_id"], "left_semi").isEmpty()
    assert negatives.groupBy("qid").count().where("count <> 5").isEmpty()


def test_draws_match_brute_force(spark):
    """The c-th unseen item of a user, taken from the listed complement."""
    df = some_ratings(spark)
    items = sorted(r["movie_id"] for r in catalogue(df).collect())
    own = {}
    for r in df.collect():
        own.setdefault(r["user_id"], set()).add(r["movie_id"])
    drawn = {}
    for r in negative_samples(df, k=5).collect():
        drawn.setdefault((r["user_id"], r["qid"]), set()).add(r["movie_id"])
    import hashlib

    for (user, qid), found in drawn.items():
        unseen = [i for i in items if i not in own[user]]
        chosen = []
        for j in range(5):
            top = len(unseen) - 5 + j
            text = f"42|{qid}|{j}".encode()
            pick = int(hashlib.md5(text).hexdigest()[:15], 16) % (top + 1)
            chosen.append(top if pick in chosen else pick)
        assert found == {unseen[c] for c in chosen}


def test_draws_cover_the_unseen_items_evenly(spark):
    df = ratings(spark, [(u, u % 10) for u in range(400)] + [(999, m) for m in range(10)])
    counts = (
        negative_samples(df.where("user_id < 999 or movie_id < 10"), k=3)
        .where("user_id < 999")
        .groupBy("movie_id")
        .count()
        .collect()
    )
    assert len(counts) == 10 and all(80 < r["count"] < 160 for r in counts)


def test_dense_user_gets_what_is_left_or_an_error(spark):
    pairs = [(1, m) for m in range(7)] + [(2, m) for m in range(7, 10)]
    df = ratings(spark, pairs)
    negatives = negative_samples(df, k=5).where("user_id = 1")
    per_row = negatives.groupBy("qid").agg(F.sort_array(F.collect_set("movie_id")).alias("m"))
    assert {tuple(r["m"]) for r in per_row.collect()} == {(7, 8, 9)}
    with pytest.raises(ValueError):
        negative_samples(df, k=5, strict=True)
    everything = ratings(spark, [(1, 1), (1, 2)])
    assert negative_samples(everything, k=5).isEmpty()


def test_union_copies_the_positive_row(spark):
    df = some_ratings(spark).withColumn("rating", F.col("movie_id") * 10 + F.col("user_id"))
    both = with_negatives(df, k=2)
    assert rows(both.groupBy("label").count()) == [(0, 2 * df.count()), (1, df.count())]
    assert both.groupBy("qid").agg(F.count_distinct("rating").alias("n")).where("n > 1").isEmpty()


def test_splits_are_disjoint_and_complete(spark):
    df = some_ratings(spark).withColumn("timestamp", F.col("movie_id"))
    numbered = ops.number_interactions(df.drop("qid"))
    split = ops.assign_split(with_negatives(numbered, k=2), n_test_users=4)
    parts = {name: ops.split_of(split, name) for name in ("train", "val", "test")}
    assert sum(p.count() for p in parts.values()) == split.count()
    assert parts["train"].where("interaction_num = 1").isEmpty()
    assert parts["val"].where("interaction_num <> 1").isEmpty()
    test_users = {r["user_id"] for r in parts["test"].collect()}
    assert len(test_users) == 4
    assert test_users.isdisjoint({r["user_id"] for r in parts["val"].collect()})
    sampled = {r["user_id"] for r in ops.sample_users(numbered, 4).collect()}
    assert test_users == sampled


def test_popular_items_and_drop_seen(spark):
    df = ratings(spark, [(1, 5), (2, 5), (1, 6), (2, 7)])
    assert [tuple(r) for r in ops.popular_items(df, 2).collect()] == [(5, 2), (6, 1)]
    pairs = spark.createDataFrame([(1, 5), (1, 7)], "user_id LONG, movie_id LONG")
    assert rows(ops.drop_seen(pairs, df)) == [(1, 7)]


def test_feature_join_keeps_unmatched_rows(spark):
    df = ratings(spark, [(1, 5), (9, 6)])
    users = spark.createDataFrame([(1, "M", "x")], "user_id LONG, gender STRING, extra STRING")
    movies = spark.createDataFrame([(6, "1990")], "movie_id LONG, year STRING")
    joined = join_features(df, users, movies, ["user_id", "gender"], ["movie_id", "year"])
    assert rows(joined, "user_id", "movie_id", "gender", "year") == [
        (1, 5, "M", None),
        (9, 6, None, "1990"),
    ]


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a DOUBLE, b DOUBLE")
    model = StandardScale(["a", "b"]).fit(df)
    assert rows(model.transform(df)) == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]
    assert rows(model.state) == [("a", 2.0, 1.0), ("b", 7.0, 1.0)]


def test_frequency_encoder(spark):
    train = spark.createDataFrame(
        [("b",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "c STRING"
    )
    model = FrequencyEncode(["c"]).fit(train)
    assert rows(model.state, "value", "id") == [("a", 3), ("b", 2), ("c", 4), (None, 1)]
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c STRING")
    assert sorted(r["c"] for r in model.transform(test).collect()) == [0, 1, 3]
    no_null = FrequencyEncode(["c"]).fit(train.where("c is not null"))
    assert sorted(r["c"] for r in no_null.transform(test).collect()) == [0, 0, 2]


def test_encoders_in_an_ml_pipeline(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "c STRING, x DOUBLE")
    fitted = Pipeline(stages=[FrequencyEncode(["c"]), StandardScale(["x"])]).fit(df)
    assert sorted(r["c"] for r in fitted.transform(df).collect()) == [1, 1, 2]

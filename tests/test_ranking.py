from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plumbline.functions import frames
from plumbline.operators import ranking, recommend

SCHEMA = "qid LONG, movie_id LONG, label INT, pred DOUBLE"


def metrics(spark, data, ks=(1, 5)):
    table = ranking.metric_table(spark.createDataFrame(data, SCHEMA), ks)
    return {r["k"]: r for r in table.collect()}


def test_all_tied_query_golden(spark):
    data = [(1, i, 1 if i == 3 else 0, 0.5) for i in range(6)]
    assert metrics(spark, data)[5]["ndcg"] == pytest.approx(0.4914099, abs=1e-7)


def test_query_without_positives_scores_zero(spark):
    data = [(1, i, 0, 0.1 * i) for i in range(3)]
    got = metrics(spark, data)[5]
    assert [got[m] for m in ranking.METRICS] == [0.0] * 4
    both = metrics(spark, data + [(2, 1, 1, 0.9)])[5]
    assert both["recall"] == 0.5, "it still counts in the mean"


def test_short_query(spark):
    got = metrics(spark, [(1, 1, 1, 0.9), (1, 2, 0, 0.1)])[5]
    assert got["precision"] == pytest.approx(0.2)
    assert (got["recall"], got["map"], got["ndcg"]) == (1.0, 1.0, 1.0)


def test_two_positives(spark):
    got = metrics(spark, [(1, 1, 1, 0.9), (1, 2, 0, 0.8), (1, 3, 1, 0.7)])
    assert (got[1]["recall"], got[1]["map"], got[1]["precision"]) == (0.5, 1.0, 1.0)
    assert got[5]["map"] == pytest.approx((1 + 2 / 3) / 2)


def test_graded_labels_use_the_sorted_ideal(spark):
    got = metrics(spark, [(1, 1, 1, 0.9), (1, 2, 3, 0.8), (1, 3, 0, 0.7)])[5]
    dcg = 1 / math.log2(2) + 3 / math.log2(3)
    ideal = 3 / math.log2(2) + 1 / math.log2(3)
    assert got["ndcg"] == pytest.approx(dcg / ideal)


def test_predictions_are_compared_as_float32(spark):
    near = 0.1 + 1e-12
    tied = metrics(spark, [(1, 1, 0, near), (1, 2, 1, 0.1)])[5]["ndcg"]
    assert tied == pytest.approx((1 + 1 / math.log2(3)) / 2)


def test_query_with_very_many_rows(spark):
    """One query holds nearly all rows; most are tied and few are positive."""
    df = spark.range(50_000).selectExpr(
        "1L AS qid",
        "id AS movie_id",
        "CAST(id % 1000 = 0 AS INT) AS label",
        "CASE WHEN id < 3 THEN 1.0 ELSE 0.5 END AS pred",
    )
    got = {r["k"]: r for r in ranking.metric_table(df, (3, 5)).collect()}
    assert got[3]["precision"] == pytest.approx(1 / 3)
    assert got[3]["recall"] == pytest.approx(1 / 50)
    tied = 49 / 49_997
    dcg = sum(1 / 3 / math.log2(r + 1) for r in (1, 2, 3))
    dcg += sum(tied / math.log2(r + 1) for r in (4, 5))
    ideal = sum(1 / math.log2(r + 1) for r in range(1, 6))
    assert got[5]["ndcg"] == pytest.approx(dcg / ideal)


def test_row_ranks_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.5)], SCHEMA)
    from pyspark.sql import functions as F

    top = ranking.top_k_within(df, ["qid"], [F.desc("pred"), F.col("movie_id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_single_metrics_and_scorer(spark):
    df = spark.createDataFrame([(1, 1, 0, 0.9), (1, 2, 1, 0.8)], SCHEMA)
    assert ranking.ndcg_at(df, 5).first()[0] == pytest.approx(1 / math.log2(3))
    assert ranking.recall_at(df, 1).first()[0] == 0.0
    assert ranking.precision_at(df, 2).first()[0] == 0.5
    assert ranking.map_at(df, 2).first()[0] == 0.5
    scorer = ranking.RankingScorer("map", 2)
    assert scorer.evaluate(df) == 0.5 and scorer.isLargerBetter()
    assert scorer.name == "map_at_2"
    with pytest.raises(ValueError):
        ranking.RankingScorer("auc")


def test_compared_models_sit_side_by_side(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.9)], SCHEMA)
    table = ranking.metric_table(df, (1, 2))
    both = ranking.compare_models(table, table)
    assert both.columns == [
        "k",
        "best_map",
        "default_map",
        "best_ndcg",
        "default_ndcg",
        "best_precision",
        "default_precision",
        "best_recall",
        "default_recall",
    ]


def test_candidates_and_recommendations(spark):
    users = spark.createDataFrame([(1,), (2,), (2,)], "user_id LONG")
    seen = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, 12)], "user_id LONG, movie_id LONG")
    pairs = recommend.candidates(users, seen, 2)
    assert rows(pairs) == [(1, 10), (1, 11), (2, 10), (2, 11)]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    scored = pairs.selectExpr("*", "CASE WHEN movie_id = 11 THEN 0.9D ELSE 0.1D END AS pred")
    top = recommend.top_recommendations(scored, 1, ordered=True)
    assert [tuple(r) for r in top.collect()] == [(1, 11, 0.9, 1), (2, 11, 0.9, 1)]


def test_query_metrics_join_without_another_shuffle(spark):
    """The joined tables stay where their aggregates left them; NULL is a query too."""
    df = spark.createDataFrame(
        [(1, 1, 1, 0.5), (1, 2, 0, 0.4), (None, 1, 1, 0.3), (None, 2, 0, 0.9)],
        "qid LONG, movie_id LONG, label INT, pred DOUBLE",
    )
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = ranking.query_metrics(df, [1])
        plan = table._jdf.queryExecution().executedPlan().toString()
        got = {r["qid"]: (r["ndcg_1"], r["recall_1"]) for r in table.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert "hashpartitioning(coalesce(" not in plan and "SortMergeJoin" in plan
    assert got == {1: (1.0, 1.0), None: (0.0, 0.0)}


def test_a_single_metric_makes_only_its_own_tables(spark):
    """Hits alone need no counts of all rows and no ideal lists, so nothing is joined."""
    df = spark.createDataFrame(
        [(1, 1, 1, 0.5), (1, 2, 0, 0.4), (2, 1, 1, 0.3), (2, 2, 0, 0.9), (None, 1, 0, 0.1)],
        "qid LONG, movie_id LONG, label INT, pred DOUBLE",
    )
    for metric, made, joins in (
        ("map", ranking.map_at(df, 1), 0),
        ("precision", ranking.precision_at(df, 1), 0),
        ("recall", ranking.recall_at(df, 1), 1),
        ("ndcg", ranking.ndcg_at(df, 1), 1),
    ):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == joins
        assert made.first()[0] == ranking.metric_table(df, [1]).first()[metric]


def _some_rows(spark):
    """Queries of one to nine rows, NULL among them, with ties and graded labels."""
    return spark.range(200).selectExpr(
        "nullif(CAST(floor(sqrt(id * 3)) AS INT), 5) AS qid",
        "id AS movie_id",
        "CAST(CASE WHEN id % 11 = 0 THEN NULL WHEN id % 7 = 0 THEN 2 ELSE id % 2 END AS INT) AS label",
        "(id * 37 % 5) / 5.0D AS pred",
    )


def test_large_queries_go_another_way_to_the_same_metrics(spark, monkeypatch):
    df = _some_rows(spark)
    usual = ranking.query_metrics(df, [1, 3, 5]).orderBy("qid").collect()
    monkeypatch.setattr(ranking, "ONE_IN", 1)
    for least, some in ((9, True), (1, True), (1000, False)):
        monkeypatch.setattr(ranking, "LARGE", least)
        assert (ranking.large_queries(df, "qid") is not None) == some
        got = ranking.query_metrics(df, [1, 3, 5]).orderBy("qid").collect()
        assert [r["qid"] for r in got] == [r["qid"] for r in usual]
        for one, other in zip(got, usual, strict=True):
            assert list(one)[1:] == pytest.approx(list(other)[1:])


def test_rows_of_a_query_are_shuffled_once(spark):
    """All metrics of k take the rows and their labels through one shuffle each."""
    table = ranking.query_metrics(_some_rows(spark), [1, 3])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "WindowGroupLimit" not in plan


def test_tasks_of_the_metrics_grow_with_the_rows(spark, monkeypatch):
    data = [(q, i, int(i == q % 6), float(i * q % 7)) for q in range(100) for i in range(6)]
    wanted = {k: r.asDict() for k, r in metrics(spark, data).items()}
    dealt_to = []

    def watched(df, size, *columns, always=False):
        made = frames.dealt(df, size, *columns, always=always)
        dealt_to.append(made.rdd.getNumPartitions())
        return made

    monkeypatch.setattr(ranking, "ONE_IN", 1)
    monkeypatch.setattr(frames, "TASK_ROWS", 20)
    monkeypatch.setattr(ranking, "dealt", watched)
    got = {k: r.asDict() for k, r in metrics(spark, data).items()}
    assert dealt_to == [30, 30]
    assert got == {k: pytest.approx(v) for k, v in wanted.items()}


def test_versions_of_predictions_have_the_metrics_of_each(spark, monkeypatch):
    df = _some_rows(spark)
    preds = ["pred", "pred * pred - pred", "0.5D"]
    versions = df.withColumn("preds", F.expr(f"array({', '.join(preds)})"))

    def by_version():
        made = ranking.query_metrics(versions, [1, 3], pred="preds", versions=3)
        return sorted((tuple(r) for r in made.collect()), key=str)

    one_by_one = [
        ranking.query_metrics(df.withColumn("pred", F.expr(pred)), [1, 3]).withColumn("version", F.lit(n))
        for n, pred in enumerate(preds)
    ]
    columns = ranking.query_metrics(versions, [1, 3], pred="preds", versions=3).columns
    wanted = rows(one_by_one[0].union(one_by_one[1]).union(one_by_one[2]), *columns)
    assert [pytest.approx(r) for r in wanted] == by_version()
    plan = ranking.query_metrics(versions, [1, 3], pred="preds", versions=3)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    monkeypatch.setattr(ranking, "ONE_IN", 1)
    for least in (1, 9):
        monkeypatch.setattr(ranking, "LARGE", least)
        assert [pytest.approx(r) for r in wanted] == by_version()

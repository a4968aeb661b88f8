"""Raw files to recommendations, and the pieces around it."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from plumbline.functions import columns as C
from plumbline.models import importance
from plumbline.models.ranker import (
    best_iteration,
    feature_matrix,
    load_model,
    predict,
    retrain,
)
from plumbline.models.search import evaluate_trial
from plumbline.plans import data_jobs, model_jobs, profiles
from plumbline.queries import models
from plumbline.settings import ModelSettings, ProcessingSettings, merged, to_json
from plumbline.sources import datasets, state, trials


def write_raw(spark, root):
    """Driver tables as ``::``-separated text files."""
    folder = f"{root}/01_raw_data"
    os.makedirs(folder)
    users = spark.read.parquet(f"{SF_DIR}/customer.parquet").selectExpr(
        "concat_ws('::', c_custkey, if(c_custkey % 3 = 0, 'F', 'M'), 18 + c_nationkey, "
        "abs(hash(c_mktsegment)) % 20, lpad(c_nationkey, 5, '0'))"
    )
    movies = spark.read.parquet(f"{SF_DIR}/part.parquet").selectExpr(
        "concat_ws('::', p_partkey, concat(p_name, if(p_size > 3, "
        "concat(' (', 1950 + p_size, ')'), '')), p_type)"
    )
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    seconds = C.epoch_seconds("o_orderdate")
    ratings = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_partkey")
        .agg(F.max("l_quantity").alias("q"), F.max(seconds).alias("ts"))
        .selectExpr("concat_ws('::', o_custkey, l_partkey, CAST(1 + q % 5 AS INT), ts)")
    )
    for name, df in (("users", users), ("movies", movies), ("ratings", ratings)):
        with open(f"{folder}/{name}.dat", "w", encoding="latin-1") as out:
            out.writelines(r[0] + "\n" for r in df.collect())


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    paths = {name: str(base / name) for name in ("training", "inference", "artefacts")}
    for name in ("training", "inference"):
        write_raw(spark, paths[name])
    return paths


@pytest.fixture(scope="module")
def finished(spark, roots):
    """All seven jobs, run once."""
    training = datasets.training_datasets(roots["training"])
    inference = datasets.inference_datasets(roots["inference"])
    processing = ProcessingSettings(n_test_users=20)
    model = ModelSettings(n_trials=1, iterations=3, early_stopping_rounds=2)
    features = f"{roots['artefacts']}/features"
    out = {"label_counts": data_jobs.process_training_data(spark, training, processing)}
    data_jobs.process_inference_data(spark, inference, processing)
    data_jobs.build_training_features(spark, training, processing, features)
    data_jobs.build_inference_features(spark, inference, processing, features)
    out["search"] = model_jobs.train_models(spark, training, model, roots["artefacts"])
    out["metrics"] = model_jobs.evaluate_models(spark, training, model, roots["artefacts"])
    model_jobs.recommend(spark, inference, model, roots["artefacts"])
    return {**out, "training": training, "inference": inference, "model": model}


def test_processed_tables(spark, finished):
    data = finished["training"]
    assert datasets.read(spark, data["users"]).columns == [
        "user_id",
        "gender",
        "age",
        "occupation",
        "zip",
    ]
    movies = datasets.read(spark, data["movies"])
    assert movies.columns == ["movie_id", "title", "year"]
    assert movies.where("year is null").count() > 0
    assert movies.where("year is not null and title not like concat('%(', year, ')')").isEmpty()
    counts = dict(rows(finished["label_counts"]))
    assert counts[0] == 5 * counts[1]
    inference = datasets.read(spark, finished["inference"]["ratings"])
    assert "label" not in inference.columns and "qid" in inference.columns


def test_split_tables(spark, finished):
    data = finished["training"]
    parts = {n: datasets.read(spark, data[n]) for n in ("train", "val", "test")}
    total = datasets.read(spark, data["ratings"]).count()
    assert sum(p.count() for p in parts.values()) == total
    wanted = {"user_id", "user_id_str", "movie_id", "movie_id_str", "gender", "age", "year"}
    assert wanted <= set(parts["train"].columns)
    mean, std = parts["train"].agg(F.avg("age"), F.stddev_pop("age")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)
    assert parts["test"].select("user_id").distinct().count() == 20
    gender = parts["train"].groupBy("gender").count().orderBy("gender").collect()
    assert gender[0]["count"] >= gender[1]["count"], "id 1 is the most frequent"


def test_saved_state(spark, finished, roots):
    folder = f"{roots['artefacts']}/features"
    loaded = merged(ProcessingSettings(), state.load_settings(spark, folder))
    assert loaded == ProcessingSettings(n_test_users=20)
    assert state.load_table(spark, folder, "label_counts").count() == 9
    ids = state.load_table(spark, f"{folder}/ids", "users")
    assert ids.count() == ids.agg(F.max("id")).first()[0]


def test_metric_table_and_csv(spark, finished, roots):
    table = finished["metrics"]
    assert [r["k"] for r in table.orderBy("k").collect()] == [1, 2, 3, 4, 5]
    back = spark.read.option("header", True).csv(f"{roots['artefacts']}/results.csv")
    assert back.columns == table.columns and back.count() == 5
    assert all(0 <= r["best_ndcg"] <= 1 for r in table.collect())


def test_recommendations(spark, finished):
    data = finished["inference"]
    top = datasets.read(spark, data["model_output"])
    users = datasets.read(spark, data["users"]).count()
    assert top.count() == 3 * users
    assert rows(top.select("rank").distinct()) == [(1,), (2,), (3,)]
    scores = top.groupBy("user_id_str").pivot("rank", [1, 2, 3]).agg(F.first("pred"))
    assert scores.where("`1` < `2` or `2` < `3`").isEmpty()


def test_trials_and_importance(spark, finished, roots):
    logged = trials.read_trials(
        spark, f"{roots['artefacts']}/trials", run=finished["search"].run
    )
    assert logged.count() == 1
    best = trials.best_trial(logged).first()
    assert best["metric"] == finished["search"].best_metric
    assert best["metric_name"] == "ndcg_at_5" and best["training_time"] > 0
    data, settings = finished["training"], finished["model"]
    train, val = datasets.read(spark, data["train"]), datasets.read(spark, data["val"])
    assert evaluate_trial(logged, 0, train, val, settings).count() == 5
    with pytest.raises(ValueError):
        trials.params_of(logged, 7)

    model = load_model(f"{roots['artefacts']}/best_model")
    table = importance.feature_importance(spark, model)
    assert table.count() == 2 * len(settings.features)
    by_type = importance.top_features_by_type(
        table, settings.categorical_features, settings.numerical_features, k=2
    )
    assert by_type.columns == [
        "importance_type",
        "feature_type",
        "feature",
        "feature_importance",
        "rank",
    ]
    names = importance.feature_names(
        importance.top_features(table, settings.categorical_features, 4)
    )
    assert sorted(names) == sorted(settings.features)
    matrix = feature_matrix(val, settings.features, "label", "qid", ordered=True)
    qids = [r["qid"] for r in matrix.select("qid").collect()]
    assert len(qids) == val.count() and qids == sorted(qids)


def test_retrain_and_command_line(spark, finished, roots):
    data, settings = finished["inference"], finished["model"]
    labelled = datasets.read(spark, finished["training"]["test"])
    model = retrain(labelled, settings, {"maxIter": 1, "maxDepth": 2})
    assert set(predict(model, labelled).columns) == {*labelled.columns, "pred"}
    before = rows(datasets.read(spark, data["model_output"]))
    paths = ["--training-root", roots["training"], "--inference-root", roots["inference"]]
    model_jobs.main(["recommend", *paths, "--artefacts", roots["artefacts"]])
    assert rows(datasets.read(spark, data["model_output"])) == before


def test_rank_first_or_filter_first(spark):
    data = [("split", f, v) for f, v in (("a", 5.0), ("b", 4.0), ("c", 3.0))]
    table = importance.ranked(spark.createDataFrame(data, importance.SCHEMA))
    ranked_first = importance.top_features_among(table, ["b", "c"], ["a"], 2)
    assert [r["feature"] for r in ranked_first.collect()] == ["b"]
    filtered_first = importance.top_features_among(
        table, ["b", "c"], ["a"], 2, filter_first=True
    )
    assert [r["feature"] for r in filtered_first.collect()] == ["b", "c"]


def test_best_iteration_stops_after_patience(spark):
    losses = [0.9, 0.5, 0.6, 0.6, 0.1]
    curve = spark.createDataFrame(
        [(i + 1, v, v) for i, v in enumerate(losses)],
        "iteration INT, train_loss DOUBLE, val_loss DOUBLE",
    )
    assert best_iteration(curve, patience=2) == 2
    assert best_iteration(curve, patience=9) == 5


def test_settings_round_trip():
    import json

    changed = replace(ProcessingSettings(), random_state=7)
    assert merged(ProcessingSettings(), json.loads(to_json(changed))) == changed
    assert merged(ProcessingSettings(), {"unknown": 1}) == ProcessingSettings()


def test_columns(spark):
    df = spark.createDataFrame([("Toy (1995)",), ("T (1995) (2001)",), ("x",)], "t STRING")
    assert [r[0] for r in df.select(C.year_of("t")).collect()] == ["1995", "1995", None]
    one = spark.range(1)
    label, month, kind = one.select(
        C.percent_label(F.lit(0.28294701)),
        C.month_text(C.epoch_to_timestamp(F.lit(978300760))),
        C.feature_kind(F.lit("age"), ["gender"]),
    ).first()
    assert (label, month, kind) == ("28.29%", "12", "numerical")
    seconds = one.select(C.epoch_seconds(C.epoch_to_timestamp(F.lit(978300760)))).first()[0]
    assert seconds == 978300760


def test_nan_is_read_as_null(spark, tmp_path):
    spec = datasets.DatasetSpec(str(tmp_path / "t"))
    datasets.write(spark.createDataFrame([(float("nan"),), (1.0,)], "x DOUBLE"), spec)
    assert rows(datasets.read(spark, spec)) == [(1.0,), (None,)]


def test_profiles(users_df):
    numeric = profiles.numeric_profile(users_df, "age", "year_month", "target")
    assert set(numeric) == {"overall", "over_time", "box", "mean", "range"}
    assert numeric["overall"].agg(F.sum("count")).first()[0] == 6040
    assert numeric["box"].count() == 5
    assert "target" not in profiles.numeric_profile(users_df, "age", "year_month")["overall"].columns

    same = profiles.categorical_profile(users_df, "target", "year_month", "target")
    assert same["overall"].columns == ["target", "count", "proportion", "target_rate"]
    assert rows(same["overall"], "target", "target_rate") == [("0", 0.0), ("1", 1.0)]
    plain = profiles.categorical_profile(users_df, "gender", "year_month")
    assert rows(plain["overall"], "gender", "count") == [("F", 1709), ("M", 4331)]

    label = profiles.label_profile(users_df, "target", "year_month")
    assert label["rate"].columns == ["year_month", "rate"]

    with_targets = profiles.numeric_feature(users_df, "age", ["target", "target"])
    assert with_targets["histogram"].count() == 10
    edges = profiles.numeric_feature(users_df, "age", edges=range(0, 110, 10))
    assert edges["histogram"].agg(F.sum("count")).first()[0] == 6040
    category = profiles.categorical_feature(users_df, "gender", ["target"])
    assert category["top"].count() == 2 and category["summary"].first()["categories"] == 2


def test_escapes(spark):
    texts = [r"caf\xe9", "\\u00e9e", "\\ud83d\\ude00!", r"a\tb\\n\101\0", "plain", "", None, r"end\\", r"\q \U0001f600", "\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = {r.i: r.d for r in df.select("i", C.decode_escapes("t").alias("d")).collect()}
    for i, t in enumerate(texts):
        if t is None or i in (7, 8, 9):
            continue
        expected = t.encode("latin-1").decode("unicode_escape")
        assert got[i] == expected.encode("utf-16", "surrogatepass").decode("utf-16")
    assert (got[6], got[7], got[8], got[9]) == (None, "end\\", "\\q \U0001f600", "\\")


def test_encoders_are_saved_with_a_pipeline(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from plumbline.operators.encoders import FrequencyEncode, StandardScale

    df = spark.createDataFrame([("a", 1.0), ("b", None), ("b", 3.0), (None, 8.0)], "c STRING, x DOUBLE")
    pipeline = Pipeline(stages=[StandardScale(["x"]), FrequencyEncode(["c"])])
    pipeline.write().overwrite().save(str(tmp_path / "p"))
    fitted = Pipeline.load(str(tmp_path / "p")).fit(df)
    for _ in range(2):
        fitted.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert [s.uid for s in back.stages] == [s.uid for s in fitted.stages]
    assert rows(back.transform(df)) == rows(fitted.transform(df)) == rows(pipeline.fit(df).transform(df))


def test_trial_search_does_the_whole_search(monkeypatch):
    seen = []

    def searched(train, val, settings, **given):
        seen.append((settings, given))
        raise InterruptedError

    monkeypatch.setattr(models, "_encoded", lambda *_, **__: ({"train": 1, "val": 2}, None, None))
    monkeypatch.setattr(models, "search", searched)
    with pytest.raises(InterruptedError):
        models.trial_search(None, "")
    settings, given = seen[0]
    usual = ModelSettings()
    assert settings.n_trials == usual.n_trials and settings.time_budget_s is None
    assert settings.iterations == usual.iterations
    assert set(given) == {"run"}, "the search space is the library's own"


def test_fitted_rows_are_stored_without_their_keys(spark):
    parts, _, _ = models._encoded(spark, SF_DIR)
    assert parts["train"].columns == ["label", *models.CATEGORIES, *models.NUMBERS]
    keyed, _, _ = models._encoded(spark, SF_DIR, ["qid", "item_id"])
    assert keyed["train"].where("qid is not null or item_id is not null").isEmpty()
    for name in ("val", "test"):
        assert keyed[name].where("qid is null or item_id is null").isEmpty()
        assert rows(keyed[name].drop("qid", "item_id")) == rows(parts[name])

"""Jobs from raw files to model tables. Each stage reads and writes stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from plumbline.functions.columns import year_of
from plumbline.operators.counts import label_counts, value_counts_within
from plumbline.operators.encoders import (
    FrequencyEncode,
    FrequencyEncodeModel,
    StandardScale,
    StandardScaleModel,
)
from plumbline.operators.features import dense_ids, encode_ids, join_features
from plumbline.operators.interactions import assign_split, number_interactions, split_of
from plumbline.operators.negatives import with_negatives
from plumbline.operators.recommend import candidate_features
from plumbline.settings import ProcessingSettings, merged, to_json
from plumbline.sources.datasets import DatasetSpec, read, write, written
from plumbline.sources.state import cut_lineage, load_settings, load_table, save_state, scratch

Datasets = Mapping[str, DatasetSpec]


def process_users(raw: DataFrame, settings: ProcessingSettings) -> DataFrame:
    return raw.select(*settings.data_user_features)


def process_movies(raw: DataFrame, settings: ProcessingSettings) -> DataFrame:
    return raw.withColumn("year", year_of("title")).select(*settings.data_movie_features)


def process_training_data(
    spark: SparkSession, data: Datasets, settings: ProcessingSettings
) -> DataFrame:
    """Raw files to processed users, movies and labelled ratings; returns label counts."""
    _process_sides(spark, data, settings)
    with scratch(spark):
        numbered = written(
            number_interactions(read(spark, data["raw_ratings"])), data["numbered_ratings"]
        )
        labelled = with_negatives(
            numbered, settings.num_negative_samples, settings.random_state
        )
        ratings = written(labelled, data["ratings"])
    return label_counts(ratings, "label")


def process_inference_data(
    spark: SparkSession, data: Datasets, settings: ProcessingSettings
) -> None:
    """The same for new data: no negatives and no label."""
    _process_sides(spark, data, settings)
    with scratch(spark):
        write(number_interactions(read(spark, data["raw_ratings"])), data["ratings"])


def _process_sides(spark: SparkSession, data: Datasets, settings: ProcessingSettings) -> None:
    write(process_users(read(spark, data["raw_users"]), settings), data["users"])
    write(process_movies(read(spark, data["raw_movies"]), settings), data["movies"])


def build_training_features(
    spark: SparkSession, data: Datasets, settings: ProcessingSettings, state_path: str
) -> None:
    """Processed tables to encoded train, val and test; the fitted state is always saved."""
    with scratch(spark):
        _build_training_features(spark, data, settings, state_path)


def _build_training_features(
    spark: SparkSession, data: Datasets, settings: ProcessingSettings, state_path: str
) -> None:
    ratings = read(spark, data["ratings"])
    user_ids = dense_ids(ratings, "user_id")
    movie_ids = dense_ids(ratings, "movie_id")
    save_state(spark, f"{state_path}/ids", {"users": user_ids, "movies": movie_ids})
    user_ids = load_table(spark, f"{state_path}/ids", "users")
    movie_ids = load_table(spark, f"{state_path}/ids", "movies")

    joined = join_features(
        ratings,
        read(spark, data["users"]),
        read(spark, data["movies"]),
        settings.model_user_features,
        settings.model_movie_features,
    )
    encoded = encode_ids(encode_ids(joined, "user_id", user_ids), "movie_id", movie_ids)
    master = cut_lineage(assign_split(encoded, settings.n_test_users, settings.random_state))

    train = split_of(master, "train")
    scaler = StandardScale(settings.numerical_features).fit(train)
    categories = FrequencyEncode(settings.categorical_features).fit(train)
    counts = value_counts_within(master, "label", "split")
    save_state(
        spark,
        state_path,
        {"scaler": scaler.state, "categories": categories.state, "label_counts": counts},
        to_json(settings),
    )
    scaler, categories = load_encoders(spark, settings, state_path)
    for name in ("train", "val", "test"):
        part = split_of(master, name)
        write(categories.transform(scaler.transform(part)), data[name])


def load_encoders(
    spark: SparkSession, settings: ProcessingSettings, state_path: str
) -> tuple[StandardScaleModel, FrequencyEncodeModel]:
    scaler = StandardScaleModel(
        settings.numerical_features, load_table(spark, state_path, "scaler")
    )
    categories = FrequencyEncodeModel(
        settings.categorical_features, load_table(spark, state_path, "categories")
    )
    return scaler, categories


def build_inference_features(
    spark: SparkSession, data: Datasets, settings: ProcessingSettings, state_path: str
) -> None:
    """Users x popular items with encoded features; ids unknown in training are NULL."""
    settings = merged(settings, load_settings(spark, state_path))
    pairs = candidate_features(
        read(spark, data["users"]),
        read(spark, data["movies"]),
        read(spark, data["ratings"]),
        settings.popular_items,
        settings.model_user_features,
        settings.model_movie_features,
    )
    for column, name in (("user_id", "users"), ("movie_id", "movies")):
        pairs = encode_ids(pairs, column, load_table(spark, f"{state_path}/ids", name))
    scaler, categories = load_encoders(spark, settings, state_path)
    write(categories.transform(scaler.transform(pairs)), data["model_input"])

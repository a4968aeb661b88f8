"""Jobs that train, evaluate and apply the ranker, and the command line for all jobs."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from plumbline.models.boosting import fit_listwise
from plumbline.models.parzen import ParzenSampler
from plumbline.models.ranker import (
    evaluate_against_default,
    fit_default,
    load_model,
    refit_on_all,
    save_model,
    score_top_k,
)
from plumbline.models.search import LISTWISE_SPACE, SearchResult, listwise_objective, search
from plumbline.plans.data_jobs import (
    Datasets,
    build_inference_features,
    build_training_features,
    process_inference_data,
    process_training_data,
)
from plumbline.session import build_session
from plumbline.settings import ModelSettings, ProcessingSettings
from plumbline.sources.datasets import (
    inference_datasets,
    read,
    training_datasets,
    write,
    write_metric_csv,
)
from plumbline.sources.state import cut_lineage


def train_models(
    spark: SparkSession, data: Datasets, settings: ModelSettings, artefacts: str
) -> SearchResult:
    """Search on train / val, then fit the best and the default model on both."""
    train, val = read(spark, data["train"]), read(spark, data["val"])
    log = f"{artefacts}/trials"
    if settings.fitted_to == "listwise":
        sampler = ParzenSampler(LISTWISE_SPACE, settings.random_state)
        objective = listwise_objective(settings)
        result = search(train, val, settings, log_path=log, objective=objective, sampler=sampler)
        both = cut_lineage(train.unionByName(val))
        chosen = {**result.best_params, "maxIter": result.best_iteration}
        best = fit_listwise(both, settings, chosen).model
        default = fit_listwise(both, settings).model
    else:
        result = search(train, val, settings, log_path=log)
        best = refit_on_all(train, val, settings, result.best_params, result.best_iteration)
        default = fit_default(train, val, settings)
    save_model(best, f"{artefacts}/best_model")
    save_model(default, f"{artefacts}/default_model")
    return result


def evaluate_models(
    spark: SparkSession, data: Datasets, settings: ModelSettings, artefacts: str
) -> DataFrame:
    """Best and default model side by side on the test rows, also as CSV."""
    table = evaluate_against_default(
        load_model(f"{artefacts}/best_model"),
        load_model(f"{artefacts}/default_model"),
        read(spark, data["test"]),
        settings,
    )
    write_metric_csv(table.orderBy("k"), f"{artefacts}/results.csv")
    return table


def recommend(
    spark: SparkSession, data: Datasets, settings: ModelSettings, artefacts: str
) -> None:
    """Best items per user. Users are told apart by their text id, which is never NULL."""
    model = load_model(f"{artefacts}/best_model")
    top = score_top_k(
        model,
        read(spark, data["model_input"]),
        settings.inference_top_k,
        user="user_id_str",
        item="movie_id_str",
        ordered=True,
    )
    write(top, data["model_output"])


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one job.")
    parser.add_argument(
        "job",
        choices=[
            "process-training",
            "process-inference",
            "features-training",
            "features-inference",
            "train",
            "evaluate",
            "recommend",
        ],
    )
    parser.add_argument("--training-root", required=True)
    parser.add_argument("--inference-root", required=True)
    parser.add_argument("--artefacts", required=True)
    parser.add_argument("--trials", type=int, default=ModelSettings().n_trials)
    parser.add_argument("--iterations", type=int, default=ModelSettings().iterations)
    parser.add_argument("--fitted-to", choices=["pointwise", "listwise"], default="pointwise")
    args = parser.parse_args(argv)

    spark = build_session("plumbline-" + args.job)
    training = training_datasets(args.training_root)
    inference = inference_datasets(args.inference_root)
    processing = ProcessingSettings()
    model = ModelSettings(
        n_trials=args.trials, iterations=args.iterations, fitted_to=args.fitted_to
    )
    state = f"{args.artefacts}/features"
    if args.job == "process-training":
        process_training_data(spark, training, processing).show()
    elif args.job == "process-inference":
        process_inference_data(spark, inference, processing)
    elif args.job == "features-training":
        build_training_features(spark, training, processing, state)
    elif args.job == "features-inference":
        build_inference_features(spark, inference, processing, state)
    elif args.job == "train":
        train_models(spark, training, model, args.artefacts)
    elif args.job == "evaluate":
        evaluate_models(spark, training, model, args.artefacts).show()
    else:
        recommend(spark, inference, model, args.artefacts)


if __name__ == "__main__":
    main()

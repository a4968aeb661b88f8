"""Job settings with the values the jobs run with unless told otherwise."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace
from typing import Any


# Column lists, counts and seeds the jobs are known by.


@dataclass(frozen=True)
class ProcessingSettings:
    num_negative_samples: int = 5
    data_user_features: tuple[str, ...] = ("user_id", "gender", "age", "occupation", "zip")
    data_movie_features: tuple[str, ...] = ("movie_id", "title", "year")
    model_user_features: tuple[str, ...] = ("user_id", "gender", "age", "occupation", "zip")
    model_movie_features: tuple[str, ...] = ("movie_id", "year")
    numerical_features: tuple[str, ...] = ("age",)
    categorical_features: tuple[str, ...] = ("gender", "occupation", "year")
    n_test_users: int = 100
    random_state: int = 42
    popular_items: int = 10


@dataclass(frozen=True)
class ModelSettings:
    categorical_features: tuple[str, ...] = ("gender", "occupation", "year")
    numerical_features: tuple[str, ...] = ("age",)
    label: str = "label"
    qid: str = "qid"
    item: str = "movie_id"
    #: ``pointwise`` or ``listwise``: what the ranker is fitted to.
    fitted_to: str = "pointwise"
    metric: str = "ndcg"
    metric_k: int = 5
    list_k: tuple[int, ...] = (1, 2, 3, 4, 5)
    n_trials: int = 20
    time_budget_s: float | None = None
    iterations: int = 200
    early_stopping_rounds: int = 100
    random_state: int = 42
    inference_top_k: int = 3

    @property
    def features(self) -> list[str]:
        return [*self.categorical_features, *self.numerical_features]


def merged(settings, saved: dict[str, Any]):
    """A copy with every known field taken from ``saved``."""
    known = {f.name for f in fields(settings)}
    values = {
        k: tuple(v) if isinstance(v, list) else v for k, v in saved.items() if k in known
    }
    return replace(settings, **values)


def to_json(settings) -> str:
    return json.dumps(asdict(settings), sort_keys=True)

"""All model types by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.models import lifetime, mllib
from tidemark.models.base import Fitted, ModelType

MODELS: dict[str, ModelType] = {
    "random_forest_regression": ModelType(True, mllib.fit_forest_regression, mllib.score_forest_value),
    "random_forest_classification": ModelType(True, mllib.fit_forest_classification, mllib.score_forest_classes),
    "tree_regression": ModelType(True, mllib.fit_tree_regression, mllib.score_value),
    "tree_classification": ModelType(True, mllib.fit_tree_classification, mllib.score_classes),
    "neural_network_classification": ModelType(True, mllib.fit_network, mllib.score_classes),
    "linear_regression": ModelType(True, mllib.fit_linear, mllib.score_value),
    "logistic_regression": ModelType(True, mllib.fit_logistic, mllib.score_classes),
    "kmeans_clustering": ModelType(False, mllib.fit_kmeans, mllib.score_clusters),
    "xgboost_classification": ModelType(True, mllib.fit_boosted_classification, mllib.score_boosted_classes),
    "xgboost_regression": ModelType(True, mllib.fit_boosted_regression, mllib.score_boosted_value),
    "dot_embedding": ModelType(True, mllib.fit_dot_embedding, mllib.score_dot),
    "beta_geometric": ModelType(False, lifetime.fit_bgnbd, lifetime.score_bgnbd),
    "gamma_gamma": ModelType(False, lifetime.fit_gammagamma, lifetime.score_gammagamma),
}


def fit_model(
    name: str, df: DataFrame, features: Sequence[str] = (), label: str | None = None, **params
) -> Fitted:
    """Train a registered model type on model-ready columns."""
    if name not in MODELS:
        raise ValueError(f"unknown model type {name}, known: {', '.join(sorted(MODELS))}")
    kind = MODELS[name]
    if kind.supervised and label is None:
        raise ValueError(f"{name} needs a label")
    return kind.fit(df, features, label, **params)

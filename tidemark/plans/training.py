"""Training runs: prepare, fit, measure, compare with production, promote."""

from __future__ import annotations

import copy
import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from datetime import datetime, timezone
from pathlib import Path

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scoring import LOSS_NAMES, loss_value, rescale_probability
from tidemark.models.base import FEATURES, PREDICTION, Fitted, load_fitted
from tidemark.models.mllib import class_index, clustered, item_vectors
from tidemark.models.registry import MODELS, fit_model
from tidemark.operators.joins import seen_values_only
from tidemark.operators.encode import categorical_features, fit_encoder, apply_encoder
from tidemark.operators.preparation import (
    ROW_KEY,
    DataSpec,
    Roles,
    apply_pca,
    apply_spec,
    fit_pca,
    fit_spec,
    fit_training_spec,
    load_spec,
    pca_names,
    save_spec,
    split_roles,
)
from tidemark.operators.profile import ProfileOptions
from tidemark.operators.sampling import train_test_split, undersample
from tidemark.operators.silhouette import euclidean_silhouette
from tidemark.plans.scoring import score_rows
from tidemark.session import opened, written
from tidemark.sources.warehouse import WRITE_TRUNCATE, Warehouse

# How the predictors reach the model.
PREPARE_FULL = "False"
PREPARE_CATEGORICAL = "enable_categorical"
PREPARE_NOTHING = "True"
UNKNOWN_LOSS = -1.0


@dataclass(frozen=True)
class TrainConfig:
    """One model's settings; submodels override single fields."""

    type: str
    purpose: str
    keys: tuple[str, ...]
    label: str | None = None
    loss: str | None = None
    train_pct: float = 0.8
    skip_preprocessing: str = PREPARE_FULL
    profile: ProfileOptions = ProfileOptions(low_info_thresh=1)
    balance_ratio: float = 0
    primary_components: int = 0
    seed: int = 0
    params: dict = field(default_factory=dict)

    def overridden(self, values: Mapping[str, object]) -> "TrainConfig":
        """A fresh copy with some settings changed: no override reaches the next submodel.

        Names of settings replace them, everything else goes to the model's parameters.
        """
        base = copy.deepcopy(self)
        known = {f.name for f in fields(self)} - {"params"}
        params = {**base.params, **values.get("params", {})}
        params |= {k: v for k, v in values.items() if k not in known and k != "params"}
        return replace(base, **{k: v for k, v in values.items() if k in known}, params=params)


@dataclass
class Trained:
    """Everything scoring needs."""

    fitted: Fitted
    spec: DataSpec | None
    pca: PipelineModel | None
    statistics: dict = field(default_factory=dict)
    items: DataFrame | None = None  # vectors of an embedding run


def _labelled(df: DataFrame, config: TrainConfig) -> DataFrame:
    return df.filter(F.col(config.label).isNotNull()) if config.label in df.columns else df


def held_out(df: DataFrame, config: TrainConfig, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; by key hash, so every model is tested on the same rows.

    ``keys`` are the key columns the rows really have: without configured keys, the row id.
    """
    no_test = config.train_pct >= 1 or not config.label or config.purpose in ("embedding", "clustering")
    if no_test or not MODELS[config.type].supervised:
        return df, df.limit(0)
    return train_test_split(df, keys, config.train_pct, config.seed)


def evaluate_loss(
    rows: DataFrame, trained: Trained, config: TrainConfig, classes: Sequence | None = None
) -> float | None:
    """Loss of a model on raw rows, measured on the scores that scoring would store."""
    name = config.loss
    if not name:
        return None
    if LOSS_NAMES.get(name) == "silhouette":
        prepared = _model_rows(rows.drop(*config.keys, ROW_KEY), trained, ())
        vectors = clustered(trained.fitted, prepared)
        return euclidean_silhouette(vectors, FEATURES, PREDICTION).value
    scored = score_rows(rows, trained.fitted, trained.spec, trained.pca, (config.label,))
    truth = F.col(config.label)
    if LOSS_NAMES.get(name) == "log":
        truth = class_index(config.label, trained.fitted.meta["classes"])
        pi, mu = trained.statistics.get("pi"), trained.statistics.get("mu")
        scored = scored.withColumn(PREDICTION, rescale_probability(F.col(PREDICTION), pi, mu))
    return loss_value(scored, name, truth, F.col(PREDICTION))


def _model_rows(df: DataFrame, trained: Trained, keep: Sequence[str]) -> DataFrame:
    rows = apply_spec(df, trained.spec, keep) if trained.spec else df
    return apply_pca(rows, trained.pca, keep) if trained.pca else rows


def train(df: DataFrame, config: TrainConfig) -> Trained:
    """Fit one model and measure it on the held-out rows."""
    if config.purpose == "embedding":
        return _train_embedding(df, config)
    if config.purpose == "survival":
        return _train_lifetime(df, config)
    df, roles = split_roles(_labelled(df, config), config.keys, config.label)
    spec, pca, features = _prepare(df, roles, config)
    carried = [*roles.keys, *([roles.label] if roles.label else [])]
    train_rows, test_rows = held_out(df, config, roles.keys)
    shell = Trained(Fitted(config.type), spec, pca)
    pi = mu = None
    fit_rows = train_rows
    if config.purpose == "classification" and config.balance_ratio > 0:
        fit_rows, pi, mu = undersample(
            train_rows, roles.label, roles.keys, config.balance_ratio, config.seed
        )
    fitted = fit_model(
        config.type, _model_rows(fit_rows, shell, carried), features, roles.label, **config.params
    )
    trained = Trained(fitted, spec, pca, {"pi": pi, "mu": mu})
    supervised = MODELS[config.type].supervised
    loss = evaluate_loss(test_rows if config.train_pct < 1 and supervised else train_rows, trained, config)
    width = len(features) if isinstance(features, list) else len(roles.predictors)
    trained.statistics = _statistics(loss, pi, mu, fit_rows.count(), test_rows.count(), width)
    return trained


def _prepare(df: DataFrame, roles: Roles, config: TrainConfig):
    """Spec, projection and feature columns for the chosen kind of preparation."""
    if config.skip_preprocessing == PREPARE_NOTHING:
        return None, None, list(roles.predictors)
    if config.skip_preprocessing == PREPARE_CATEGORICAL:
        return None, None, categorical_features(df, roles.predictors)
    if not config.primary_components:
        spec = fit_training_spec(df, roles.predictors, config.profile)
        return spec, None, spec.expanded
    spec = fit_spec(df, roles.predictors, config.profile)  # components need a column per value
    pca = fit_pca(apply_spec(df, spec), spec.expanded, config.primary_components)
    return spec, pca, pca_names(config.primary_components)


def _statistics(loss, pi, mu, train_rows, test_rows, width) -> dict:
    return {
        "utc_timestamp": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        "mu": mu, "pi": pi, "loss": loss,
        "train_rows": train_rows, "test_rows": test_rows, "columns": width,
    }


def _train_lifetime(df: DataFrame, config: TrainConfig) -> Trained:
    fitted = fit_model(config.type, df, **config.params)
    return Trained(fitted, None, None, _statistics(None, None, None, df.count(), 0, 0))


def _train_embedding(df: DataFrame, config: TrainConfig) -> Trained:
    """Subject and item are numbered first; the model sees codes only.

    Rows held out count where training knows both their subject and their item.
    """
    subject, item = config.params["subject"], config.params["item"]
    train_rows, test_rows = df, df.limit(0)
    if config.train_pct < 1:
        keys = config.keys or (subject, item)
        train_rows, test_rows = train_test_split(df, keys, config.train_pct, config.seed)
        test_rows = seen_values_only(test_rows, train_rows, [subject, item])
    codes = {column: fit_encoder(train_rows, column) for column in (subject, item)}

    def coded(rows: DataFrame) -> DataFrame:
        for column, encoder in codes.items():
            rows = apply_encoder(rows, column, encoder, f"{column}_code")
        return rows

    params = {k: v for k, v in config.params.items() if k not in ("subject", "item")}
    fitted = fit_model(
        config.type, coded(train_rows), (f"{subject}_code", f"{item}_code"), config.label, **params
    )
    loss = None
    if config.loss:
        scored = fitted.score(coded(test_rows if config.train_pct < 1 else train_rows))
        loss = loss_value(scored, config.loss, F.col(config.label), F.col(PREDICTION))
    statistics = _statistics(loss, None, None, train_rows.count(), test_rows.count(), 2)
    return Trained(fitted, None, None, statistics, item_vectors(fitted, codes[item], item))


# ---- configuration files --------------------------------------------------------

# Configuration file names and the settings they spell differently.
GLOBAL_FILE = "model_config_global.json"
SUBMODEL_FILE = "submodel_params.json"
SETTING_NAMES = {
    "key_list": "keys", "label_column": "label", "loss_function": "loss",
    "subject_input_name": "subject", "item_input_name": "item",
    "target_column_name": "target", "pred_key": "key", "pred_destination_table": "table",
    "bq_write_method": "method",
}


def _settings(values: Mapping[str, object]) -> dict:
    named = {SETTING_NAMES.get(k, k): v for k, v in values.items()}
    if "keys" in named:
        named["keys"] = tuple(named["keys"])
    if "low_info_thresh" in named:
        named["profile"] = ProfileOptions(low_info_thresh=float(named.pop("low_info_thresh")))
    return named


def load_configuration(
    folder: str, only: Sequence[str] = ()
) -> tuple[TrainConfig, dict[str, dict]]:
    """A model's settings and the overrides of its (chosen) submodels."""
    settings = _settings(json.loads((Path(folder) / GLOBAL_FILE).read_text()))
    submodels = json.loads((Path(folder) / SUBMODEL_FILE).read_text())
    base = TrainConfig(
        type=settings.pop("type"), purpose=settings.pop("purpose"), keys=settings.pop("keys", ())
    )
    chosen = {k: _settings(v) for k, v in submodels.items() if not only or k in only}
    return base.overridden(settings), chosen


# ---- versions -------------------------------------------------------------------

RUN_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("submodel_name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("promoted", T.BooleanType()),
        T.StructField("utc_timestamp", T.StringType()),
        T.StructField("mu", T.DoubleType()),
        T.StructField("pi", T.DoubleType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("production_loss", T.DoubleType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("columns", T.LongType()),
    ]
)


class ModelStore:
    """Model versions under one folder and the log of runs that made them.

    A run's log row is written after its model is complete. The newest promoted row of
    a submodel points at the version in production.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log_path = f"{self.folder}/runs"

    def runs(self) -> DataFrame:
        return opened(self.spark, self.log_path, RUN_SCHEMA)

    def _newest(self, model: str, submodel: str, promoted_only: bool):
        rows = self.runs().filter(
            (F.col("model_name") == model) & (F.col("submodel_name") == submodel)
        )
        if promoted_only:
            rows = rows.filter("promoted")
        return rows.orderBy(F.desc("version")).first()

    def production(self, model: str, submodel: str):
        """Log row of the version in production, or None."""
        return self._newest(model, submodel, promoted_only=True)

    def path(self, model: str, submodel: str, version: int) -> str:
        """Folder of one version: model, spec, and what the run stored beside them."""
        return f"{self.folder}/models/{model}/{submodel}/v{version}"

    def save(
        self, trained: Trained, model: str, submodel: str, promoted: bool,
        production_loss: float | None = None,
    ) -> int:
        last = self._newest(model, submodel, promoted_only=False)
        version = last["version"] + 1 if last else 1
        path = self.path(model, submodel, version)
        trained.fitted.save(self.spark, f"{path}/model")
        if trained.spec is not None:
            save_spec(self.spark, trained.spec, f"{path}/spec")
        if trained.pca is not None:
            trained.pca.write().overwrite().save(f"{path}/pca")
        parts = json.dumps({"spec": trained.spec is not None, "pca": trained.pca is not None})
        self.spark.createDataFrame([(parts,)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/parts")
        row = {
            "model_name": model, "submodel_name": submodel, "version": version, "path": path,
            "promoted": promoted, "production_loss": production_loss, **trained.statistics,
        }
        values = [tuple(row[f.name] for f in RUN_SCHEMA.fields)]
        self.spark.createDataFrame(values, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(
            self.log_path
        )
        return version

    def load(self, path: str) -> Trained:
        parts = json.loads(self.spark.read.text(f"{path}/parts").first()["value"])
        return Trained(
            load_fitted(self.spark, f"{path}/model"),
            load_spec(self.spark, f"{path}/spec") if parts["spec"] else None,
            PipelineModel.load(f"{path}/pca") if parts["pca"] else None,
        )


def should_promote(
    new_loss: float | None, old_loss: float | None, comparable: bool
) -> bool:
    """Replace production when nothing can be compared, the old loss is unknown, or the new is lower."""
    if not comparable or old_loss is None or old_loss == UNKNOWN_LOSS:
        return True
    return new_loss is not None and new_loss < old_loss


def run_submodel(
    df: DataFrame, config: TrainConfig, store: ModelStore, model: str, submodel: str,
    house: Warehouse | None = None,
) -> dict:
    """Train a challenger, test the champion on the same held-out rows, keep the better one.

    Preparing, fitting and testing read the input many times, so the result of the
    input query is written out once first. The version's folder also gets the rows the model
    was made from (``training_data``), or the item vectors of an embedding run
    (``item_vectors``); with a ``house`` those also replace the table
    ``<model>_<submodel>_items``.
    """
    df = written(df, "training-input")
    trained = train(df, config)
    current = store.production(model, submodel)
    comparable = (
        current is not None
        and MODELS[config.type].supervised
        and config.purpose != "embedding"
        and config.skip_preprocessing != PREPARE_NOTHING
    )
    old_loss = None
    if comparable:
        rows, roles = split_roles(_labelled(df, config), config.keys, config.label)
        # with nothing held out both are measured on the rows the challenger was trained on
        test_rows = rows if config.train_pct >= 1 else held_out(rows, config, roles.keys)[1]
        try:
            champion = store.load(current["path"])
            champion.statistics = {"pi": current["pi"], "mu": current["mu"]}
            old_loss = evaluate_loss(test_rows, champion, config)
        except (AnalysisException, IllegalArgumentException, KeyError):  # a champion that cannot score today's columns loses
            old_loss = UNKNOWN_LOSS
    promoted = should_promote(trained.statistics["loss"], old_loss, comparable)
    version = store.save(trained, model, submodel, promoted, old_loss)
    path = store.path(model, submodel, version)
    if trained.items is not None:
        trained.items.write.mode("overwrite").parquet(f"{path}/item_vectors")
        if house is not None:
            vectors = df.sparkSession.read.parquet(f"{path}/item_vectors")
            house.write(vectors, re.sub(r"\W", "_", f"{model}_{submodel}_items"), write=WRITE_TRUNCATE)
    elif config.label in df.columns:
        rows, roles = split_roles(_labelled(df, config), config.keys, config.label)
        save_training_data(rows, trained.spec, roles.keys, config.label, f"{path}/training_data")
    return {
        "version": version, "loss": trained.statistics["loss"],
        "production_loss": old_loss, "promoted": promoted,
    }


STATUS_SCHEMA = (
    "submodel_name string, status string, loss double, production_loss double, "
    "promoted boolean, error string"
)


def run_submodels(
    spark: SparkSession,
    config: TrainConfig,
    submodels: Mapping[str, Mapping[str, object]],
    run: Callable[[str, TrainConfig], dict],
    only: Sequence[str] = (),
) -> DataFrame:
    """Run every (chosen) submodel with its overrides; a failure is reported, not fatal."""
    rows = []
    for name, overrides in submodels.items():
        if only and name not in only:
            continue
        try:
            outcome = run(name, config.overridden(overrides))
            rows.append(
                (name, "done", outcome.get("loss"), outcome.get("production_loss"),
                 outcome.get("promoted"), None)
            )
        except Exception as error:
            rows.append((name, "failed", None, None, None, f"{type(error).__name__}: {error}"[:2000]))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def save_training_data(
    df: DataFrame, spec: DataSpec | None, keys: Sequence[str], label: str, path: str
) -> None:
    """Model columns and label beside each other, with their keys."""
    rows = df
    if spec is not None:
        labelled = df.withColumn("_label", F.col(f"`{label}`"))
        rows = apply_spec(labelled, spec, [*keys, "_label"]).withColumnRenamed("_label", label)
    rows.write.mode("overwrite").parquet(path)

"""Prediction records: scores with their keys, typed for the prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scoring import classification_output, rescale_probability
from tidemark.models.base import PREDICTION, Fitted
from tidemark.operators.preparation import DataSpec, apply_pca, apply_spec
from tidemark.sources.schema import PREDICTION_SCHEMAS
from tidemark.sources.warehouse import Warehouse
from tidemark.operators.upsert import write_predictions


def model_value(purpose: str, prediction: Column, pi=None, mu=None) -> Column:
    """A raw prediction in the shape its purpose stores."""
    if purpose == "classification":
        return classification_output(rescale_probability(prediction, pi, mu))
    return prediction


def prediction_records(
    scored: DataFrame,
    purpose: str,
    key: str,
    model_name: str,
    submodel_name: str,
    execution_id: int,
    rank: int | None = None,
    target: str | None = None,
    pi: float | None = None,
    mu: float | None = None,
) -> DataFrame:
    """Rows of the prediction table of ``purpose`` from a ``prediction`` column.

    The target column's current value is kept beside the score, 0 when it is null,
    empty or absent.
    """
    if purpose not in PREDICTION_SCHEMAS:
        raise ValueError(f"unknown purpose {purpose}")
    current: Column = F.lit(0)
    if target in scored.columns:
        filled = F.col(target).cast("string") != ""
        current = F.coalesce(F.when(filled, F.col(target).cast("double")), F.lit(0.0))
    values = {
        "ts": F.lit(execution_id),
        "target_column_current_value": current,
        "model_value": model_value(purpose, F.col(PREDICTION), pi, mu),
        "model_name": F.lit(model_name),
        "submodel_name": F.lit(submodel_name),
        "id": F.col(key),
        "submodel_rank": F.lit(rank),
    }
    columns = []
    for field in PREDICTION_SCHEMAS[purpose].fields:
        value = values[field.name]
        if field.name == "model_value" and purpose in ("classification", "survival"):
            wanted = field.dataType.elementType.fieldNames()
            value = F.transform(value, lambda v: F.struct(*[v[n].alias(n) for n in wanted]))
        columns.append(value.cast(field.dataType).alias(field.name))
    return scored.select(*columns)


def score_rows(
    df: DataFrame, fitted: Fitted, spec: DataSpec | None, pca=None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Prepared by the stored spec, then scored; ``keep`` columns ride along."""
    rows = df
    if spec is not None:
        carried = [c for c in keep if c in df.columns]
        # A kept column may also be a predictor: carry it under another name.
        renamed = df.withColumns({f"_keep_{c}": F.col(f"`{c}`") for c in carried})
        rows = apply_spec(renamed, spec, [f"_keep_{c}" for c in carried])
        if pca is not None:
            rows = apply_pca(rows, pca, [f"_keep_{c}" for c in carried])
        scored = fitted.score(rows)
        return scored.select(
            *[F.col(f"`_keep_{c}`").alias(c) for c in carried], PREDICTION
        )
    return fitted.score(rows)


def predict_submodel(
    house: Warehouse,
    store,
    df: DataFrame,
    model_name: str,
    submodel_name: str,
    purpose: str,
    key: str,
    execution_id: int,
    table: str = "predictions",
    rank: int | None = None,
    target: str | None = None,
    method: str = "merge",
) -> DataFrame:
    """Score ``df`` with the model in production and store the records."""
    version = store.production(model_name, submodel_name)
    if version is None:
        raise ValueError(f"{model_name}/{submodel_name} has no model in production")
    trained = store.load(version["path"])
    keep = tuple(dict.fromkeys([key, *([target] if target else [])]))
    scored = score_rows(df, trained.fitted, trained.spec, trained.pca, keep)
    records = prediction_records(
        scored, purpose, key, model_name, submodel_name, execution_id, rank, target,
        version["pi"], version["mu"],
    )
    return write_predictions(house, records, table, method)

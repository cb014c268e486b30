"""Column expressions on scores, and losses as aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1 in the log loss.
EPSILON = 2.220446049250313e-16

LOSS_NAMES = {
    "mse": "mse", "mean_squared_error": "mse", "squared_error": "mse",
    "mae": "mae", "mean_absolute_error": "mae",
    "log_loss": "log", "binary_crossentropy": "log", "log": "log",
    "silhouette_score": "silhouette",
}


def proba_normalize(scores: Column) -> Column:
    """Scores divided by their sum."""
    total = F.aggregate(scores, F.lit(0.0), lambda total, x: total + x)
    return F.transform(scores, lambda x: x / total)


def rescale_probability(proba: Column, pi: float | None, mu: float | None) -> Column:
    """Undo undersampling: ``[1 - p', p']`` from the score of the second class.

    ``pi`` is the true share of the class, ``mu`` its share in training; without
    either the scores stay as they are.
    """
    if not pi or not mu:
        return proba
    p = F.get(proba, F.lit(1))
    true = (pi * (1 - mu)) * p / ((pi - mu) * p + mu * (1 - pi))
    return F.array(1 - true, true)


def classification_output(proba: Column) -> Column:
    """``array<struct<class, value>>``, class is the position, value is text."""
    return F.transform(
        proba, lambda v, i: F.struct(i.alias("class"), plain_text(v).alias("value"))
    )


def plain_text(value: Column) -> Column:
    """A number as text in plain digits: small ones are not written with an exponent."""
    digits = value.cast("decimal(38,20)").cast("string")
    return F.coalesce(F.regexp_replace(digits, r"(\.\d+?)0+$", "$1"), value.cast("string"))


def mse(truth: Column, predicted: Column) -> Column:
    return F.avg((truth - predicted) * (truth - predicted))


def mae(truth: Column, predicted: Column) -> Column:
    return F.avg(F.abs(truth - predicted))


def log_loss(class_position: Column, proba: Column) -> Column:
    """Mean negative log of the true class's score, clipped and renormalised.

    A row of a class that has no score (no position) costs as much as one scored 0.
    """
    clipped = F.transform(proba, lambda p: F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1 - EPSILON)))
    score = F.get(proba_normalize(clipped), class_position.cast("int"))
    return F.avg(-F.log(F.coalesce(score, F.lit(EPSILON))))


def loss_value(df: DataFrame, name: str | None, truth: Column, predicted: Column) -> float | None:
    """One of the row-wise losses; no name means no loss."""
    if not name:
        return None
    if name not in LOSS_NAMES:
        raise ValueError(f"unknown loss {name}")
    losses: dict[str, Callable[[Column, Column], Column]] = {"mse": mse, "mae": mae, "log": log_loss}
    kind = LOSS_NAMES[name]
    if kind not in losses:
        raise ValueError(f"{name} is not computed row by row")
    return df.agg(losses[kind](truth, predicted).alias("loss")).first()["loss"]

"""What every fitted model looks like, and how it is stored."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

FEATURES = "features"
PREDICTION = "prediction"


@dataclass(frozen=True)
class Fitted:
    """A trained model: an MLlib pipeline, or parameters alone (lifetime models).

    ``meta`` holds plain JSON values: class list, parameters, column names; ``parts`` what is too large for it.
    """

    name: str
    pipeline: PipelineModel | None = None
    meta: dict = field(default_factory=dict)
    parts: list[bytes] | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``prediction`` column."""
        from tidemark.models.registry import MODELS

        return MODELS[self.name].score(self, df)

    def save(self, spark: SparkSession, path: str) -> None:
        head = json.dumps({"name": self.name, "meta": self.meta, "pipeline": self.pipeline is not None, "parts": self.parts is not None})
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/head"
        )
        if self.pipeline is not None:
            self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.parts is not None:
            parts = spark.createDataFrame(list(enumerate(self.parts)), "place int, part binary")
            parts.write.mode("overwrite").parquet(f"{path}/parts")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    head = json.loads(spark.read.text(f"{path}/head").first()["value"])
    pipeline = PipelineModel.load(f"{path}/pipeline") if head["pipeline"] else None
    parts = [r["part"] for r in spark.read.parquet(f"{path}/parts").orderBy("place").collect()] if head.get("parts") else None
    return Fitted(head["name"], pipeline, head["meta"], parts)


class ModelType(NamedTuple):
    """A registry entry."""

    supervised: bool
    fit: Callable[..., Fitted]
    score: Callable[[Fitted, DataFrame], DataFrame]

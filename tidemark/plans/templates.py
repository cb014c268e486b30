"""A folder of parameterised SQL texts, run as Spark queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.joins import join_on_keys


def load_templates(folder: str) -> dict[str, str]:
    """Texts of all ``.sql`` files by name, in name order."""
    return {file.stem: file.read_text() for file in sorted(Path(folder).glob("*.sql"))}


def run_templates(
    spark: SparkSession, templates: Mapping[str, str], parameters: Mapping[str, object]
) -> dict[str, DataFrame]:
    """One lazy result per template.

    Values are bound as ``:name`` (never pasted into the text); table names go
    through ``IDENTIFIER(:name)``.
    """
    return {name: spark.sql(text, args=dict(parameters)) for name, text in templates.items()}


def joined_templates(
    spark: SparkSession,
    templates: Mapping[str, str],
    parameters: Mapping[str, object],
    keys: Sequence[str],
) -> DataFrame:
    """All template results joined on their keys."""
    return join_on_keys(list(run_templates(spark, templates, parameters).values()), keys)

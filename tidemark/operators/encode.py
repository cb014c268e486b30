"""Values numbered in sorted order, for columns of any cardinality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.position import with_position
from tidemark.operators.profile import CATEGORIAL, is_numeric, profile_columns


def fit_encoder(df: DataFrame, column: str) -> DataFrame:
    """``(value, code)``: distinct values in their own order, codes from 0.

    Numbers sort as numbers. The table grows with the distinct values and never
    leaves the executors.
    """
    values = df.select(F.col(f"`{column}`").alias("value")).filter(F.col("value").isNotNull())
    return with_position(values.distinct(), ["value"], "code")


def apply_encoder(
    df: DataFrame, column: str, encoder: DataFrame, name: str | None = None
) -> DataFrame:
    """Add the code of each value; rows with unknown or null values have none."""
    codes = encoder.select(F.col("value").alias(column), F.col("code").alias(name or f"{column}_code"))
    return df.join(codes, column, "left")


def decode(df: DataFrame, code: str, encoder: DataFrame, name: str) -> DataFrame:
    """Add the value behind each code."""
    return df.join(encoder.select(F.col("code").alias(code), F.col("value").alias(name)), code)


def label_encode(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace every column by its codes; returns the encoders too."""
    encoders = {}
    for column in columns:
        encoders[column] = fit_encoder(df, column)
        df = apply_encoder(df, column, encoders[column], "_code").drop(column)
        df = df.withColumnRenamed("_code", column)
    return df, encoders


def categorical_features(
    df: DataFrame, columns: Sequence[str], output: str = "features"
) -> Pipeline:
    """Category columns kept as categories for tree models, other numbers untouched.

    Text columns, and numeric columns that profile as categorial, are indexed and marked as
    nominal, so trees split them by value; unseen and missing values share one extra category.
    """
    numbers = [c for c in columns if is_numeric(df.schema[c].dataType)]
    few = {p.column for p in profile_columns(df, numbers) if p.type == CATEGORIAL} if numbers else set()
    text = [c for c in columns if c not in numbers or c in few]
    indexed = [f"{c}_index" for c in text]
    inputs = [f"{c}_index" if c in text else c for c in columns]
    stages = []
    if text:
        stages.append(
            StringIndexer(
                inputCols=text, outputCols=indexed, handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def sparse_features(
    df: DataFrame, columns: Sequence[str], output: str = "features"
) -> Pipeline:
    """0/1 features of text columns with very many values, as one sparse vector.

    The wide form of the spec's category columns: a row stores its own values only, so
    the width costs nothing per row. Numbers pass through; unseen values share one
    extra slot per column.
    """
    text = [c for c in columns if not is_numeric(df.schema[c].dataType)]
    indexed, flags = [f"{c}_index" for c in text], [f"{c}_flags" for c in text]
    stages = []
    if text:
        stages = [
            StringIndexer(
                inputCols=text, outputCols=indexed, handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=flags, dropLast=False, handleInvalid="keep"),
        ]
    inputs = [f"{c}_flags" if c in text else c for c in columns]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)

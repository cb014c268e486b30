"""From raw columns to model-ready columns, by a stored column spec.

The spec is fitted once and is tiny (one entry per raw column). Applying it is a
single projection: no join, no shuffle, the same columns in the same order every time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.profile import (
    CATEGORIAL,
    LABELS,
    MULTILABEL,
    NULL_TEXT,
    REGULAR,
    TEXT,
    ColumnProfile,
    ProfileOptions,
    is_numeric,
    labels_of,
    profile_columns,
    value_text,
)

ROW_KEY = "row_id"


@dataclass(frozen=True)
class Roles:
    """Which columns are keys, label and predictors."""

    keys: tuple[str, ...]
    label: str | None
    predictors: tuple[str, ...]


@dataclass(frozen=True)
class ColumnSpec:
    """How one raw column becomes model columns."""

    column: str
    type: str
    numeric: bool
    mean: float | None = None
    std: float | None = None
    values: tuple[str, ...] = ()
    expanded: tuple[str, ...] = ()
    separator: str = ","


@dataclass(frozen=True)
class DataSpec:
    """Column specs in order; ``expanded`` names the model columns."""

    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)

    @property
    def expanded(self) -> list[str]:
        return [name for spec in self.columns for name in spec.expanded]


SPEC_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("column", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("numeric", T.BooleanType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("values", T.ArrayType(T.StringType())),
        T.StructField("expanded", T.ArrayType(T.StringType())),
        T.StructField("separator", T.StringType()),
    ]
)


def split_roles(
    df: DataFrame, keys: Sequence[str] = (), label: str | None = None
) -> tuple[DataFrame, Roles]:
    """Name the key, label and predictor columns; an empty input is an error.

    Without key columns each row gets a ``row_id``, a hash of its values, which a row keeps
    however often the input is computed; equal rows share it. A label column that is not there
    means there is no label.
    """
    if df.isEmpty():
        raise ValueError("the input holds no rows")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"no such key columns: {', '.join(missing)}")
    label = label if label in df.columns else None
    predictors = tuple(c for c in df.columns if c not in keys and c != label)
    if not keys:
        df, keys = df.withColumn(ROW_KEY, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), [ROW_KEY]
    return df, Roles(tuple(keys), label, predictors)


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class in class order; as many as the model has outputs."""
    found = class_counts(df, label).orderBy(label).collect()
    return {r[label]: r["n"] for r in found}


def label_classes(df: DataFrame, label: str) -> list:
    """Sorted classes of a discrete label."""
    return list(class_sizes(df, label))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_onehot(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    """One 0/1 column ``<label>_<class>`` per class instead of the label."""
    flags = [
        F.coalesce((F.col(label) == c).cast("int"), F.lit(0)).alias(f"{label}_{c}") for c in classes
    ]
    others = [F.col(f"`{c}`") for c in df.columns if c != label]
    return df.select(*others, *flags)


# ---- fitting --------------------------------------------------------------------


def _is_low_info(count: int, rows: int, threshold: float) -> bool:
    """A 0/1 column whose commoner value fills more than ``threshold`` of the rows."""
    return max(count, rows - count) / rows > threshold


def _natural(values: Sequence[str], numeric: bool) -> tuple[str, ...]:
    if not numeric:
        return tuple(sorted(values))
    return tuple(sorted(values, key=lambda v: (v == "nan", int(v) if v != "nan" else 0)))


def _spec(profile: ColumnProfile, options: ProfileOptions) -> ColumnSpec:
    base = ColumnSpec(
        profile.column, profile.type, profile.numeric, profile.mean, profile.std,
        separator=options.separator,
    )
    if profile.type == REGULAR:
        return replace(base, expanded=(profile.column,))
    kept = [
        value
        for value, count in sorted(profile.counts.items())
        if not _is_low_info(count, profile.rows, options.low_info_thresh)
    ]
    if profile.type == CATEGORIAL and profile.numeric and set(profile.counts) == {"0", "1"}:
        kept = [v for v in kept if v != "0"]
    return replace(
        base,
        values=_natural(list(profile.counts), profile.numeric and profile.type == CATEGORIAL),
        expanded=tuple(f"{profile.column}_{v}" for v in kept),
    )


def fit_spec(
    df: DataFrame, predictors: Sequence[str], options: ProfileOptions = ProfileOptions()
) -> DataSpec:
    """Profile the predictors and decide every model column."""
    profiles = profile_columns(df, predictors, options)
    return DataSpec(tuple(_spec(p, options) for p in profiles))


def fit_training_spec(
    df: DataFrame, predictors: Sequence[str], options: ProfileOptions = ProfileOptions()
) -> DataSpec:
    """Numbers as in ``fit_spec``; text columns stay one column each, whatever their values.

    The model's own pipeline turns their values, or their labels where any value holds the
    separator, into one sparse vector. A ``low_info_thresh`` below 1 leaves values out and
    bounds how many stay, so those specs list them.
    """
    if options.low_info_thresh < 1:
        return fit_spec(df, predictors, options)
    text = [c for c in predictors if not is_numeric(df.schema[c].dataType)]
    numbers = [c for c in predictors if c not in text]
    specs = {s.column: s for s in fit_spec(df, numbers, options).columns} if numbers else {}
    if text:
        many = df.agg(
            *[F.max(F.contains(F.col(f"`{c}`").cast("string"), F.lit(options.separator))) for c in text]
        ).first()
        for column, labels in zip(text, many):
            kind = LABELS if labels else TEXT
            specs[column] = ColumnSpec(column, kind, False, expanded=(column,), separator=options.separator)
    return DataSpec(tuple(specs[c] for c in predictors))


# ---- applying -------------------------------------------------------------------


def _scaled(spec: ColumnSpec) -> Column:
    value = F.col(f"`{spec.column}`").cast("double")
    if spec.mean is None:  # nothing but nulls in fitting
        return F.lit(None).cast("double")
    if not spec.std:
        return F.when(value.isNotNull(), value - F.lit(spec.mean))
    return (value - F.lit(spec.mean)) / F.lit(spec.std)


def _model_columns(spec: ColumnSpec, present: bool) -> list[Column]:
    if spec.type == TEXT:
        value = value_text(spec.column, False) if present else F.lit(NULL_TEXT)
        return [value.alias(spec.column)]
    if spec.type == LABELS:
        value = labels_of(spec.column, spec.separator) if present else F.array().cast("array<string>")
        return [value.alias(spec.column)]
    if not present:
        return [F.lit(0).alias(name) for name in spec.expanded]
    if spec.type == REGULAR:
        return [_scaled(spec).alias(spec.column)]
    cut = len(spec.column) + 1
    if spec.type == CATEGORIAL:
        text = value_text(spec.column, spec.numeric)
        return [(text == name[cut:]).cast("int").alias(name) for name in spec.expanded]
    if spec.type == MULTILABEL:
        labels = labels_of(spec.column, spec.separator)
        return [
            F.array_contains(labels, name[cut:]).cast("int").alias(name) for name in spec.expanded
        ]
    raise ValueError(f"unknown column type {spec.type}")


def apply_spec(df: DataFrame, spec: DataSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Model columns in spec order after the ``keep`` columns.

    Values unseen in fitting yield zeros, raw columns that are gone yield zero
    columns, unknown raw columns are left out.
    """
    columns = [F.col(f"`{c}`") for c in keep]
    for entry in spec.columns:
        columns += _model_columns(entry, entry.column in df.columns)
    return df.select(*columns)


# ---- storing --------------------------------------------------------------------


def spec_rows(spark: SparkSession, spec: DataSpec) -> DataFrame:
    """The spec as a table, one row per raw column."""
    rows = [
        (i, s.column, s.type, s.numeric, s.mean, s.std, list(s.values), list(s.expanded), s.separator)
        for i, s in enumerate(spec.columns)
    ]
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def save_spec(spark: SparkSession, spec: DataSpec, path: str) -> None:
    spec_rows(spark, spec).coalesce(1).write.mode("overwrite").parquet(path)


def load_spec(spark: SparkSession, path: str) -> DataSpec:
    rows = spark.read.schema(SPEC_SCHEMA).parquet(path).orderBy("position").collect()
    return DataSpec(
        tuple(
            ColumnSpec(
                r["column"], r["type"], r["numeric"], r["mean"], r["std"],
                tuple(r["values"]), tuple(r["expanded"]), r["separator"],
            )
            for r in rows
        )
    )


# ---- principal components -------------------------------------------------------


def fit_pca(df: DataFrame, columns: Sequence[str], components: int) -> PipelineModel:
    """Centring and projection on the first principal components."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="_raw"),
            StandardScaler(withMean=True, withStd=False, inputCol="_raw", outputCol="_centred"),
            PCA(k=components, inputCol="_centred", outputCol="_pc"),
        ]
    ).fit(df)


def pca_names(components: int) -> list[str]:
    return [f"pc_{i}" for i in range(components)]


def apply_pca(df: DataFrame, model: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """``pc_0``, ``pc_1``, ... in place of the model columns."""
    names = pca_names(model.stages[-1].getK())
    projected = model.transform(df).withColumn("_pc", vector_to_array("_pc"))
    return projected.select(
        *[F.col(f"`{c}`") for c in keep],
        *[F.col("_pc")[i].alias(name) for i, name in enumerate(names)],
    )

"""Declared JSON schemas as Spark types, and the schemas of prediction tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import types as T

# Warehouse type names.
TYPE_NAMES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIME": T.StringType(),
}
RECORD_NAMES = ("RECORD", "STRUCT")


def _field(entry: Mapping) -> T.StructField:
    kind = entry["type"].upper()
    if kind in RECORD_NAMES:
        data_type: T.DataType = schema_from_json(entry["fields"])
    elif kind in TYPE_NAMES:
        data_type = TYPE_NAMES[kind]
    else:
        raise ValueError(f"unknown type {entry['type']} of column {entry['name']}")
    mode = (entry.get("mode") or "NULLABLE").upper()
    if mode == "REPEATED":
        data_type = T.ArrayType(data_type)
    metadata = {"description": entry.get("description") or ""}
    return T.StructField(entry["name"], data_type, mode != "REQUIRED", metadata)


def schema_from_json(entries: Sequence[Mapping]) -> T.StructType:
    """``[{"name", "type", "mode", "description", "fields"}, ...]`` as a Spark schema."""
    return T.StructType([_field(entry) for entry in entries])


def schema_from_file(path: str) -> T.StructType:
    return schema_from_json(json.loads(Path(path).read_text()))


def _records(model_value: T.DataType) -> T.StructType:
    return (
        T.StructType()
        .add("ts", T.LongType())
        .add("target_column_current_value", T.DoubleType())
        .add("model_value", model_value)
        .add("model_name", T.StringType())
        .add("submodel_name", T.StringType())
        .add("id", T.LongType())
        .add("submodel_rank", T.LongType())
    )


CLASS_VALUES = T.ArrayType(
    T.StructType().add("value", T.DoubleType()).add("class", T.LongType())
)
MEASURE_VALUES = T.ArrayType(
    T.StructType().add("measure", T.StringType()).add("value", T.DoubleType())
)
# Prediction tables by purpose of the model.
PREDICTION_SCHEMAS = {
    "classification": _records(CLASS_VALUES),
    "regression": _records(T.DoubleType()),
    "clustering": _records(T.DoubleType()),
    "survival": _records(MEASURE_VALUES),
}

"""Rows as JSON text or as one flat list of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: ISO timestamps in row JSON.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
}


def row_json(df: DataFrame) -> Column:
    """The whole row as one JSON text, nulls kept."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), JSON_OPTIONS)


def rows_to_json(df: DataFrame, name: str = "row") -> DataFrame:
    return df.select(row_json(df).alias(name))


def rows_to_vector(df: DataFrame, name: str = "value", position: str | None = None) -> DataFrame:
    """All cells as one column, row by row; ``position`` adds the cell's place in its row."""
    cells = F.array(*[F.col(f"`{c}`") for c in df.columns])
    if position is None:
        return df.select(F.explode(cells).alias(name))
    return df.select(F.posexplode(cells).alias(position, name))

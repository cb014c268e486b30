"""Scalar column expressions: category cleaning, weekday, differences, defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MISSING = "missing"
NON_ASCII = r"[^\x00-\x7F]+"
WEEKDAY_PREFIX = "weekday_"
GENDER_CODES = {"hombre": "M", "mujer": "F"}


def clean_category(value: Column) -> Column:
    """Null becomes ``missing``, non-ASCII runs go, each space becomes ``missing``."""
    ascii_only = F.regexp_replace(F.coalesce(value, F.lit(MISSING)), NON_ASCII, "")
    return F.replace(ascii_only, F.lit(" "), F.lit(MISSING))


def weekday_category(moment: Column) -> Column:
    """``weekday_1`` (Sunday) to ``weekday_7``."""
    return F.concat(F.lit(WEEKDAY_PREFIX), F.dayofweek(moment).cast("string"))


def whole_units(unit: str, start: Column, end: Column) -> Column:
    """Whole DAYs / HOURs from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff(unit, start, end)


def map_codes(value: Column, codes: Mapping[str, str] = GENDER_CODES) -> Column:
    """Case-insensitive replacement of listed values, others unchanged."""
    mapped = value
    for source, target in codes.items():
        mapped = F.when(F.lower(value) == source, F.lit(target)).otherwise(mapped)
    return mapped


def null_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column, keeping each column's type (NaN is kept too)."""
    types = {name: df.schema[name].dataType for name in defaults}
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
            for name, value in defaults.items()
        }
    )


def assemble_defaults(
    df: DataFrame,
    structure: Mapping[str, object],
    static: Mapping[str, object] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Model input with one column per name in ``structure``.

    A static value wins over the row's own column, which wins over the default.
    The default stands in for an absent column only: an explicit null stays null.
    """
    static = static or {}
    columns = [F.col(k) for k in keep or []]
    for name, default in structure.items():
        if name in static:
            columns.append(F.lit(static[name]).alias(name))
        elif name in df.columns:
            columns.append(F.col(name))
        else:
            columns.append(F.lit(default).alias(name))
    return df.select(*columns)

"""Control rows turned into per-table date windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_windows(
    control: DataFrame,
    days_offset: int = 0,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """``(table_name, date_from, date_to)`` days to process next, one row per table.

    ``control`` holds the last processed range of each table. The window starts
    ``days_offset`` days before it; an explicit start or end wins.
    """
    start = F.date_sub(F.to_date("date_from"), days_offset)
    stop = F.to_date("date_to")
    return control.select(
        "table_name",
        (F.lit(date_from).cast("date") if date_from else start).alias("date_from"),
        (F.lit(date_to).cast("date") if date_to else stop).alias("date_to"),
    )


def window_variables(windows: DataFrame) -> dict[str, str]:
    """``{<table>_date_from: day, <table>_date_to: day}``; one control row per table."""
    variables = {}
    for row in windows.collect():
        variables[f"{row['table_name']}_date_from"] = row["date_from"].isoformat()
        variables[f"{row['table_name']}_date_to"] = row["date_to"].isoformat()
    return variables


def incremental_rows(
    tables: Mapping[str, tuple[DataFrame, str]], windows: DataFrame
) -> dict[str, DataFrame]:
    """Each table cut to its own window, both days in.

    The bounds are read once as plain values, so each filter reaches its file scan.
    """
    bounds = {row["table_name"]: row for row in windows.collect()}
    cut = {}
    for name, (df, column) in tables.items():
        row = bounds[name]
        data_type = df.schema[column].dataType
        start = F.lit(row["date_from"]).cast(data_type)
        stop = F.date_add(F.lit(row["date_to"]), 1).cast(data_type)
        cut[name] = df.filter((F.col(column) >= start) & (F.col(column) < stop))
    return cut

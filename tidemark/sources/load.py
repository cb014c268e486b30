"""Files loaded into a catalog table in one call."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import read_delimited, read_ndjson
from tidemark.sources.warehouse import CREATE_IF_NEEDED, WRITE_APPEND, Warehouse

# Source formats.
CSV = "CSV"
NEWLINE_DELIMITED_JSON = "NEWLINE_DELIMITED_JSON"


def load_files(
    house: Warehouse,
    table: str,
    path: str | list[str],
    source_format: str,
    schema: T.StructType | None = None,
    autodetect: bool = False,
    write: str = WRITE_APPEND,
    create: str = CREATE_IF_NEEDED,
    bad_record_limit: int = 0,
    ignore_unknown_values: bool = False,
    date_partition_column: str | None = None,
    date_partition_expiration_days: int | None = None,
    as_of: date | None = None,
    **csv_settings,
) -> DataFrame:
    """Read CSV or JSON lines and store them, by day of a column if one is named.

    Types come from the schema, or from the data when ``autodetect`` is on. Day
    partitions older than the expiration are dropped after the load, counted back from
    ``as_of`` (by default the last day in the table).
    """
    if schema is None and not autodetect:
        raise ValueError("a load needs a schema, or autodetect")
    limits = {"bad_record_limit": bad_record_limit, "ignore_unknown_values": ignore_unknown_values}
    if source_format == CSV:
        rows = read_delimited(house.spark, path, schema, **limits, **csv_settings)
    elif source_format == NEWLINE_DELIMITED_JSON:
        rows = read_ndjson(house.spark, path, schema, **limits)
    else:
        raise ValueError(f"unsupported format {source_format}")
    if date_partition_column is None:
        return house.write(rows, table, write, create)
    house.write_by_day(rows, table, date_partition_column, write=write, create=create)
    if date_partition_expiration_days is not None:
        last = as_of or house.table(table).agg(F.max("day").alias("d")).first()["d"]
        if last is not None:
            house.expire_days(table, date_partition_expiration_days, last)
    return house.table(table)

"""Results as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Export formats and compressions on offer.
FORMATS = {"CSV": "csv", "NEWLINE_DELIMITED_JSON": "json"}
COMPRESSIONS = ("NONE", "GZIP")


def export_files(
    df: DataFrame,
    path: str,
    file_format: str = "CSV",
    compression: str = "NONE",
    header: bool = True,
    delimiter: str = ",",
    split_files: bool = True,
    max_records_per_file: int = 0,
    mode: str = "error",
) -> None:
    """Write CSV or JSON lines.

    Split output follows the partitions of the result, optionally capped per file.
    One single file is written by one task, so it is only made when asked for; the query
    before it keeps its own tasks.
    """
    if file_format not in FORMATS:
        raise ValueError(f"unsupported format {file_format}, use one of {sorted(FORMATS)}")
    if compression not in COMPRESSIONS:
        raise ValueError(f"unsupported compression {compression}")
    rows = df if split_files else df.repartition(1)
    writer = rows.write.mode(mode).option("compression", compression.lower())
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if file_format == "CSV":
        writer.csv(path, header=header, sep=delimiter)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def counted_write(df: DataFrame, write) -> int:
    """Run ``write(df)`` and return how many rows went through, in the same job."""
    seen = Observation("rows written")
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def query_to_csv(df: DataFrame, path: str) -> int:
    """Write CSV with a header and return the row count."""
    return counted_write(df, lambda rows: rows.write.csv(path, header=True))

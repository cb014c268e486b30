"""Row positions, chunks and folds without gathering rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import new_location


def _file_order() -> list[Column]:
    """Written files in row order: by task number, then by file number of the task."""
    return [
        F.regexp_extract("_file", r"^part-(\d+)-", 1).cast("int"),
        F.regexp_extract("_file", r"-c(\d+)\.", 1).cast("int"),
    ]


def _placed(df: DataFrame, keys: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """Rows with their place, and how many there are."""
    spark = df.sparkSession
    path = new_location(spark, "ordered")
    df.orderBy(*keys).write.parquet(path)
    files = spark.read.schema(df.schema).parquet(path)
    rows = files.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    # One row per written file: small enough for a window without partitioning.
    before = Window.orderBy(*_file_order()).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_count"))
        .select("_file", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    )
    placed = (
        rows.join(F.broadcast(starts), "_file")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_file", "_row", "_start")
    )
    return placed, files.count()


def with_position(df: DataFrame, keys: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with each row's place (0, 1, ...) in the order of unique ``keys``.

    The sorted rows are written once; a row's place is its place inside its file plus
    the row counts of the files before it. Range partitioning keeps every task even
    and the written files fix the order for good, also when executors are lost.
    """
    return _placed(df, keys, name)[0]


def chunk_rows(
    df: DataFrame, keys: Sequence[str], chunks: int | None = None, batch_size: int | None = None
) -> DataFrame:
    """Consecutive chunks: ``chunks`` of them sized ``int(n / chunks) + 1``, or fixed batches."""
    if (chunks is None) == (batch_size is None):
        raise ValueError("give either chunks or batch_size")
    placed, rows = _placed(df, keys, "position")
    size = batch_size or rows // chunks + 1
    return placed.withColumn("chunk", F.floor(F.col("position") / size).cast("long"))


def kfold(df: DataFrame, keys: Sequence[str], folds: int = 5) -> DataFrame:
    """``fold`` 1..k: contiguous parts in key order, the first ``n mod k`` one row longer."""
    if folds < 2:
        raise ValueError("at least two folds")
    placed, total = _placed(df, keys, "position")
    small, longer = divmod(total, folds)
    if small == 0:
        raise ValueError(f"{folds} folds need at least as many rows, there are {total}")
    cut = longer * (small + 1)
    place = F.col("position")
    fold = F.when(place < cut, F.floor(place / (small + 1))).otherwise(
        longer + F.floor((place - cut) / small)
    )
    return placed.withColumn("fold", (fold + 1).cast("int"))

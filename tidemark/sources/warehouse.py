"""Catalog tables: dispositions, partitions, slices, copies, shards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import configure
from tidemark.sources.export import counted_write

# Disposition names.
WRITE_APPEND = "WRITE_APPEND"
WRITE_TRUNCATE = "WRITE_TRUNCATE"
WRITE_EMPTY = "WRITE_EMPTY"
CREATE_IF_NEEDED = "CREATE_IF_NEEDED"
CREATE_NEVER = "CREATE_NEVER"
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Warehouse:
    """Parquet tables of one database whose folder all executors share."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = configure(spark)
        self.database = database
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def location(self) -> str:
        return self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")

    def _must_exist(self, table: str) -> None:
        if not self.exists(table):
            raise ValueError(f"table {self.database}.{table} does not exist")

    def write(
        self,
        df: DataFrame,
        table: str,
        write: str = WRITE_APPEND,
        create: str = CREATE_IF_NEEDED,
        schema: T.StructType | None = None,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Store a result and return the table."""
        if write not in (WRITE_APPEND, WRITE_TRUNCATE, WRITE_EMPTY):
            raise ValueError(f"unknown write disposition {write}")
        exists = self.exists(table)
        if create == CREATE_NEVER:
            self._must_exist(table)
        elif create != CREATE_IF_NEEDED:
            raise ValueError(f"unknown create disposition {create}")
        if write == WRITE_EMPTY and exists and not self.table(table).isEmpty():
            raise ValueError(f"table {self.database}.{table} is not empty")
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        mode = "overwrite" if write == WRITE_TRUNCATE else "append"
        writer = df.write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.name(table))
        return self.table(table)

    def create(
        self, table: str, schema: T.StructType, day_column: str | None = None
    ) -> None:
        """Create an empty table if it is absent, partitioned by the day of a column."""
        if self.exists(table):
            return
        empty = self.spark.createDataFrame([], schema)
        self.write_by_day(empty, table, day_column) if day_column else self.write(empty, table)

    def write_by_day(
        self, df: DataFrame, table: str, time_column: str, day: str = "day", **settings
    ) -> DataFrame:
        """Store with one partition per day of ``time_column``."""
        # one or a few even files per day: large days are split, small ones share a task
        by_day = df.withColumn(day, F.to_date(time_column)).hint("rebalance", day)
        return self.write(by_day, table, partition_by=[day], **settings)

    def expire_days(self, table: str, keep_days: int, as_of: date, day: str = "day") -> int:
        """Drop day partitions older than ``keep_days`` before ``as_of``.

        Whole partitions leave the catalog: no data file is read or rewritten.
        """
        oldest = (as_of - timedelta(days=keep_days)).isoformat()
        prefix = f"{day}="
        days = [
            row["partition"][len(prefix):]
            for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").toLocalIterator()
        ]
        expired = [d for d in days if d != DEFAULT_PARTITION and d < oldest]
        if expired:
            specs = ", ".join(f"PARTITION (`{day}`='{d}')" for d in expired)
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {specs}")
        return len(expired)

    def replace_slices(self, df: DataFrame, table: str, slice_columns: Sequence[str]) -> DataFrame:
        """Replace exactly the slices that ``df`` holds rows of; others stay.

        Slices are partitions, so a rerun overwrites its own output and no other.
        """
        if not self.exists(table):
            return self.write(df, table, partition_by=slice_columns)
        target = self.table(table)
        ordered = df.select(*[F.col(f"`{c}`") for c in target.columns])
        ordered.write.insertInto(self.name(table), overwrite=True)
        return self.table(table)

    def drop_slice(self, table: str, **values: object) -> None:
        """Remove one slice, for a rerun that yields no row at all."""
        self._must_exist(table)
        spec = ", ".join(f"`{k}`='{v}'" for k, v in values.items())
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({spec})")

    def copy(
        self, source: str, target: str, to: "Warehouse | None" = None, write: str = WRITE_TRUNCATE
    ) -> int:
        """Copy a table; a copy without rows is an error. Returns the row count."""
        self._must_exist(source)
        place = to or self
        rows = counted_write(
            self.table(source), lambda df: place.write(df, target, write=write)
        )
        if rows == 0:
            raise ValueError(f"copy of {source} to {target} holds no rows")
        return rows

    def delete_rows(self, table: str) -> None:
        """Remove all rows, keep the table and its schema."""
        self._must_exist(table)
        self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def date_ends(self, table: str, column: str) -> DataFrame:
        """First and last day of a column."""
        return date_ends(self.table(table), column)

    def shard_ends(self, prefix: str) -> DataFrame:
        """First and last day among the tables ``<prefix>YYYYMMDD`` that hold rows.

        Only file names are looked at, no column is read.
        """
        shards = self.spark.read.parquet(f"{self.location()}/{prefix}" + "[0-9]" * 8)
        suffix = F.regexp_extract("_metadata.file_path", f"/{prefix}([0-9]{{8}})/", 1)
        day = F.to_date(suffix, "yyyyMMdd")
        return shards.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def date_ends(df: DataFrame, column: str) -> DataFrame:
    """First and last day of a column."""
    return df.agg(
        F.to_date(F.min(column)).alias("min_date"), F.to_date(F.max(column)).alias("max_date")
    )

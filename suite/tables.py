"""Access to the test tables and shared bits of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import configure


class Check(NamedTuple):
    """A registered query and the SQL that must give the same rows, if SQL can."""

    query: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Tables:
    """``t.events`` reads ``<sf_dir>/events.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, table)
        return table


def check(build: Callable[[Tables], DataFrame], sql: str | None = None) -> Check:
    """Register ``build`` with portable output types."""
    return Check(lambda spark, sf_dir: portable(build(Tables(spark, sf_dir))), sql)


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles, all integers as bigint."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def money(column: str | Column) -> Column:
    """Exact two-decimal amount, so that the order of addition cannot matter."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("decimal(18,2)")


def key_number(props: str = "props") -> Column:
    """The ``k`` of an event's JSON properties."""
    return F.get_json_object(props, "$.k").cast("int")

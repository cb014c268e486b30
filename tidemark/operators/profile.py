"""Column types decided from the data, and the numbers each type needs.

Two passes over the input, whatever the number of columns: one aggregate for sizes,
means and deviations, one count of the values of the category-like columns. The counts
stay a table, the dictionary; of a column with many values only those come to the
driver that ``low_info_thresh`` leaves as model columns.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Sequence
from decimal import Decimal
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import written

# Column type names and the text that stands for null.
REGULAR = "regular"
CATEGORIAL = "categorial"
MULTILABEL = "multilabel"
NULL_TEXT = "nan"

# Kinds that keep their values in the rows: any number of them, no list of them in the spec.
TEXT = "text"
LABELS = "labels"


class ProfileOptions(NamedTuple):
    max_cat_val: int = 100
    max_cat_ratio: float = 0.0001
    separator: str = ","
    low_info_thresh: float = 0.99


class ColumnProfile(NamedTuple):
    column: str
    type: str
    numeric: bool
    rows: int
    mean: float | None
    std: float | None
    #: Rows per value or label of a category-like column: of all values while they are at most
    #: ``max_cat_val``, else of those that are neither too rare nor too common to tell rows apart.
    counts: dict[str, int]
    distinct: int = 0  # values or labels there are


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def value_text(column: str, numeric: bool) -> Column:
    """A category value as text: numbers as integers, null as ``nan``."""
    value = F.col(f"`{column}`")
    # NaN and infinite numbers have no whole number and count as null.
    text = value.try_cast("long").cast("string") if numeric else value.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def labels_of(column: str, separator: str) -> Column:
    """The distinct labels of a multilabel text; none for null."""
    parts = F.split(F.col(f"`{column}`"), re.escape(separator), -1)
    return F.coalesce(F.array_distinct(parts), F.array().cast("array<string>"))


def _first_pass(df: DataFrame, columns: Sequence[str], separator: str) -> dict:
    """Rows, mean, deviation and estimated distinct values or separator use."""
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`")
        if is_numeric(df.schema[name].dataType):
            number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            measures += [
                F.avg(number).alias(f"mean_{i}"),
                F.stddev_pop(number).alias(f"std_{i}"),
                F.approx_count_distinct(value, 0.02).alias(f"about_{i}"),
            ]
        else:
            measures.append(
                F.max(F.contains(value.cast("string"), F.lit(separator))).alias(f"many_{i}")
            )
    return df.agg(*measures).first().asDict()


# One slot per kind of value, so that numbers are grouped as numbers.
ITEM = "struct<column: int, whole: bigint, number: double, text: string>"


def _item(df: DataFrame, columns: Sequence[str], name: str, label: Column | None = None) -> Column:
    """A value tagged with its column."""
    kind = df.schema[name].dataType
    value = F.col(f"`{name}`") if label is None else label
    whole = number = text = F.lit(None)
    if label is None and isinstance(kind, T.IntegralType):
        whole = value
    elif label is None and isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        number = value
    else:
        text = value.cast("string")
    if label is None and text is not None and not is_numeric(kind):
        text = F.coalesce(text, F.lit(NULL_TEXT))
    place = F.lit(list(columns).index(name))
    return F.struct(place, whole, number, text).cast(ITEM)


def value_counts(
    df: DataFrame, single: Sequence[str], multi: Sequence[str], separator: str
) -> DataFrame:
    """Rows per value of the ``single`` columns and per label of the ``multi`` columns.

    One scan and one shuffle for all of them; ``column`` is the place in
    ``[*single, *multi]``.
    """
    columns = [*single, *multi]
    items = [F.array(*[_item(df, columns, name) for name in single])] if single else []
    items += [
        F.transform(labels_of(name, separator), partial(_item, df, columns, name)) for name in multi
    ]
    return (
        df.select(F.explode(F.concat(*items)).alias("i"))
        .groupBy("i.column", "i.whole", "i.number", "i.text")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _informative(listed: DataFrame, rows: int, options: ProfileOptions) -> DataFrame:
    """Counts of the columns with few values, and of others those that pass ``low_info_thresh``; with ``distinct`` of each column.

    A value passes if it and its absence both have a share of the rows of ``1 - low_info_thresh``
    or more, so at most ``1 / (1 - low_info_thresh)`` values of a column do. With a threshold of
    1 every value is a model column, and all are listed.
    """
    distinct = listed.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    passes = F.greatest(F.col("n"), rows - F.col("n")) / rows <= options.low_info_thresh
    return listed.join(F.broadcast(distinct), "column").filter((F.col("distinct") <= options.max_cat_val) | passes)


def _collected_counts(
    counts: DataFrame, columns: Sequence[str], numeric: set[str]
) -> dict[str, dict[str, int]]:
    """Rows per category text, by column. Fractions become whole numbers here, after counting."""
    by_column: dict[str, dict[str, int]] = {name: defaultdict(int) for name in columns}
    for row in counts.toLocalIterator():
        name = columns[row["column"]]
        whole = row["whole"]
        if row["number"] is not None and math.isfinite(row["number"]):
            whole = int(row["number"])
        text = row["text"] if whole is None else str(whole)
        if name in numeric and text is not None and whole is None:
            text = str(int(Decimal(text)))
        by_column[name][NULL_TEXT if text is None else text] += row["n"]
    return {name: dict(values) for name, values in by_column.items()}


def dictionary(df: DataFrame, columns: Sequence[str], options: ProfileOptions = ProfileOptions()) -> DataFrame:
    """Every value of text columns and every label of those that hold the separator: ``column``, ``value``, ``n``.

    A table, however many values there are; null is ``nan``.
    """
    first = _first_pass(df, columns, options.separator)
    multi = [c for i, c in enumerate(columns) if first.get(f"many_{i}")]
    single = [c for c in columns if c not in multi]
    names = F.array(*[F.lit(c) for c in [*single, *multi]])
    counts = value_counts(df, single, multi, options.separator)
    value = F.coalesce("text", F.col("whole").cast("string"), F.col("number").cast("string"), F.lit(NULL_TEXT))
    return counts.select(names[F.col("column")].alias("column"), value.alias("value"), "n")


def profile_columns(
    df: DataFrame, columns: Sequence[str], options: ProfileOptions = ProfileOptions()
) -> list[ColumnProfile]:
    """Type of every column.

    Numeric: categorial when it has at most ``max_cat_val`` distinct values and their
    share of the rows is below ``max_cat_ratio``, else regular. Other columns:
    multilabel when any value holds the separator, else categorial. Null counts as a
    value. Distinct values are estimated first; the columns whose estimate comes
    anywhere near the limit are then counted exactly.
    """
    first = _first_pass(df, columns, options.separator)
    rows = first["rows"]
    numeric = {name: is_numeric(df.schema[name].dataType) for name in columns}
    near = 1.2 * options.max_cat_val + 5
    near_ratio = 1.2 * options.max_cat_ratio * rows + 5
    maybe = [
        name
        for i, name in enumerate(columns)
        if numeric[name] and first[f"about_{i}"] <= min(near, near_ratio)
    ]
    multi = [c for i, c in enumerate(columns) if not numeric[c] and first[f"many_{i}"]]
    single = [c for c in columns if c in maybe or not (numeric[c] or c in multi)]
    counts, distinct = {}, {}
    if single or multi:
        columns_ = [*single, *multi]
        listed = written(value_counts(df, single, multi, options.separator), "dictionary")
        sizes = listed.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
        distinct = {columns_[r["column"]]: r["n"] for r in sizes}
        counts = _collected_counts(_informative(listed, rows, options), columns_, {name for name in single if numeric[name]})

    def type_of(name: str) -> str:
        if name in multi:
            return MULTILABEL
        if not numeric[name]:
            return CATEGORIAL
        few = name in maybe and distinct.get(name, 0) <= options.max_cat_val
        return CATEGORIAL if few and distinct.get(name, 0) / rows < options.max_cat_ratio else REGULAR

    profiles = []
    for i, name in enumerate(columns):
        kind = type_of(name)
        values = {} if kind == REGULAR else counts.get(name, {})
        profiles.append(
            ColumnProfile(
                name, kind, numeric[name], rows, first.get(f"mean_{i}"), first.get(f"std_{i}"), values,
                0 if kind == REGULAR else distinct.get(name, 0),
            )
        )
    return profiles

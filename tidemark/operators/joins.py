"""Joins beyond a plain equality join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_matches(
    pairs: DataFrame, lookup: DataFrame, group: Sequence[str], item: str, name: str
) -> DataFrame:
    """Per group, how many of its distinct items occur in ``lookup``; 0 is kept.

    Both sides are reduced to distinct rows before the join, so an item that fills a
    third of the input still meets the lookup once per group.
    """
    shared = [c for c in group if c in lookup.columns]
    wanted = lookup.select(*shared, item).distinct().withColumn("_found", F.lit(1))
    return (
        pairs.select(*group, item)
        .distinct()
        .join(wanted, [*shared, item], "left")
        .groupBy(*group)
        .agg(F.count("_found").alias(name))
    )


def join_on_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of several results on common keys; other column names must differ."""
    if not frames:
        raise ValueError("nothing to join")
    names = Counter(c for df in frames for c in df.columns if c not in keys)
    clashes = sorted(name for name, times in names.items() if times > 1)
    if clashes:
        raise ValueError(f"columns in more than one result: {', '.join(clashes)}")
    return reduce(lambda left, right: left.join(right, list(keys), "inner"), frames)


def seen_values_only(
    validation: DataFrame, training: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Validation rows whose every value occurs in the same training column.

    Per column only distinct values are compared; the rows themselves meet the
    (usually few) unseen values, so a dominant value never gathers its rows in one
    task. A null counts as a value.
    """
    kept = validation
    for column in columns:
        known = training.select(F.col(column).alias("_known")).distinct()
        unseen = (
            validation.select(F.col(column).alias("_value"))
            .distinct()
            .join(known, F.col("_value").eqNullSafe(F.col("_known")), "left_anti")
        )
        kept = kept.join(unseen, F.col(column).eqNullSafe(F.col("_value")), "left_anti")
    return kept

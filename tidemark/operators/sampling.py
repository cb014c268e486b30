"""Seeded splits and exact per-class samples, stable under recomputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.preparation import class_sizes

SPLIT_STEPS = 1_000_000
HASH_BUCKETS = 65_536


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """A number that depends on the row's key and the seed only."""
    return F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))


def train_test_split(
    df: DataFrame, keys: Sequence[str], train_pct: float = 0.8, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete parts; a row stays in its part whenever it is recomputed."""
    in_train = F.pmod(row_hash(keys, seed), F.lit(SPLIT_STEPS)) < int(train_pct * SPLIT_STEPS)
    return df.filter(in_train), df.filter(~in_train)


def sample_per_class(
    df: DataFrame, label: str, keys: Sequence[str], sizes: dict, seed: int = 0
) -> DataFrame:
    """Exactly ``sizes[class]`` rows of each class, chosen by the hash of their key.

    Rows fall into hash buckets. Bucket counts tell which bucket of a class crosses
    its size: earlier buckets are taken whole, and only the crossing bucket, one in
    65,536 of the class, is ranked row by row.
    """
    hashed = df.withColumn("_hash", row_hash(keys, seed)).withColumn(
        "_bucket", F.pmod(F.col("_hash"), F.lit(HASH_BUCKETS)).cast("int")
    )
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col(label)]
    upto = Window.partitionBy(label).orderBy("_bucket")
    crossing = (
        hashed.groupBy(label, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_seen", F.sum("_n").over(upto))
        .withColumn("_wanted", wanted)
        .filter((F.col("_seen") >= F.col("_wanted")) & (F.col("_seen") - F.col("_n") < F.col("_wanted")))
        .select(
            label,
            F.col("_bucket").alias("_last"),
            (F.col("_wanted") - F.col("_seen") + F.col("_n")).alias("_rest"),
        )
    )
    # One row per class.
    placed = hashed.join(F.broadcast(crossing), label)
    whole = placed.filter(F.col("_bucket") < F.col("_last"))
    within = Window.partitionBy(label).orderBy("_hash", *keys)
    last = (
        placed.filter(F.col("_bucket") == F.col("_last"))
        .withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= F.col("_rest"))
        .drop("_rank")
    )
    return whole.unionByName(last).select(*[F.col(f"`{c}`") for c in df.columns])


def undersample(
    df: DataFrame, label: str, keys: Sequence[str], ratio: float = 1, seed: int = 0
) -> tuple[DataFrame, float, float]:
    """Cut every class to ``ratio`` times the smallest one.

    Returns the rows, ``pi`` (share of the second class before) and ``mu`` (share of
    the smallest class after).
    """
    counts = class_sizes(df, label)
    if len(counts) < 2:
        raise ValueError("undersampling needs at least two classes")
    smallest = min(counts.values())
    sizes = {c: min(int(smallest * ratio), n) for c, n in counts.items()}
    pi = list(counts.values())[1] / sum(counts.values())
    mu = min(sizes.values()) / sum(sizes.values())
    return sample_per_class(df, label, keys, sizes, seed), pi, mu

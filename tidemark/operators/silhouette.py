"""Mean silhouette of a clustering, on Euclidean distances of a sample or on squared ones of all points.

The mean squared distance of a point to a cluster follows from the cluster's size, sum and
sum of squares, so the work is linear in the points: no pair of points is looked at. Plain
Euclidean distances have no such sums; they are measured inside a seeded sample of bounded
size, which every task gets and measures its share of.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Points of a sample, about, and of one block of distances.
SAMPLE_POINTS, BLOCK_POINTS = 10_000, 500


def squared_silhouette(df: DataFrame, features: str, cluster: str) -> float:
    """Mean silhouette; ``features`` is a vector column."""
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, distanceMeasure="squaredEuclidean"
    ).evaluate(df)


def point_silhouettes(df: DataFrame, key: str, features: str, cluster: str) -> DataFrame:
    """``(key, silhouette)`` per point; the only point of a cluster has 0.

    One aggregate gives size and sums per cluster, as many rows as clusters times
    dimensions; a second scan measures the points against them.
    """
    points = df.select(
        key, F.col(features).cast("array<double>").alias("x"), F.col(cluster).cast("long").alias("c")
    )
    sums = points.select("c", F.posexplode("x").alias("dim", "v")).groupBy("c", "dim").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")
    )
    found = sums.toPandas().sort_values(["c", "dim"])
    names = np.unique(found["c"].to_numpy())
    if len(names) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    sizes = found.groupby("c")["n"].first().to_numpy().astype(float)
    centres = found["s"].to_numpy().reshape(len(names), -1) / sizes[:, None]
    squares = found.groupby("c")["q"].sum().to_numpy() / sizes
    shared = df.sparkSession.sparkContext.broadcast((names, sizes, centres, squares))

    def measure(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clusters, counts, middle, square = shared.value
        for part in blocks:
            x = np.vstack(part["x"].to_numpy())
            means = (x * x).sum(axis=1)[:, None] - 2 * x @ middle.T + square
            mine, rows = np.searchsorted(clusters, part["c"].to_numpy()), np.arange(len(part))
            alone = counts[mine] == 1
            inside = means[rows, mine] * counts[mine] / np.maximum(counts[mine] - 1, 1)
            means[rows, mine] = np.inf
            outside = means.min(axis=1)
            larger = np.maximum(np.maximum(inside, outside), np.finfo(float).tiny)
            yield pd.DataFrame({key: part[key].to_numpy(), "silhouette": np.where(alone, 0.0, (outside - inside) / larger)})

    kind = df.schema[key].dataType.simpleString()
    return points.mapInPandas(measure, f"`{key}` {kind}, silhouette double")


def silhouette(df: DataFrame, key: str, features: str, cluster: str) -> float:
    """Mean of the points' silhouettes."""
    points = point_silhouettes(df, key, features, cluster)
    return points.agg(F.avg("silhouette").alias("s")).first()["s"]


class Silhouette(NamedTuple):
    """Mean of the sampled points' silhouettes, its standard error, and how many points there were."""

    value: float
    error: float
    points: int


def _coordinates(df: DataFrame, features: str) -> Column:
    if isinstance(df.schema[features].dataType, T.ArrayType):
        return F.col(features).cast("array<double>")
    return vector_to_array(features)


def euclidean_point_silhouettes(df: DataFrame, key: str, features: str, cluster: str, sample: int = SAMPLE_POINTS, seed: int = 0) -> DataFrame:
    """``(key, silhouette)`` of each point of a sample, on distances inside the sample.

    About ``sample`` points are drawn by a hash of their coordinates, all if there are no more,
    so points of one place are drawn together. Coordinates and clusters of the sample go to
    every task (``sample`` times the dimensions); distances are measured block by block where
    the points lie. The only point of a cluster has 0.
    """
    points = df.select(key, _coordinates(df, features).alias("x"), F.col(cluster).cast("long").alias("c"))
    share = min(1.0, sample / max(points.count(), 1))
    drawn = points.filter(F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    held = drawn.select("x", "c").toPandas()
    names, cluster_of = np.unique(held["c"].to_numpy(), return_inverse=True)
    if len(names) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    counts = np.bincount(cluster_of)
    order = np.argsort(cluster_of, kind="stable")
    shared = df.sparkSession.sparkContext.broadcast((names, counts, np.vstack(held["x"].to_numpy())[order]))

    def measure(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clusters, sizes, others = shared.value
        starts = np.cumsum(sizes) - sizes
        squares = (others * others).sum(axis=1)
        for whole in blocks:
            for lo in range(0, len(whole), BLOCK_POINTS):
                part = whole.iloc[lo : lo + BLOCK_POINTS]
                x = np.vstack(part["x"].to_numpy())
                far = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ others.T + squares, 0.0))
                sums = np.add.reduceat(far, starts, axis=1)
                mine, rows = np.searchsorted(clusters, part["c"].to_numpy()), np.arange(len(part))
                inside = sums[rows, mine] / np.maximum(sizes[mine] - 1, 1)
                means = sums / sizes
                means[rows, mine] = np.inf
                outside = means.min(axis=1)
                larger = np.maximum(np.maximum(inside, outside), np.finfo(float).tiny)
                yield pd.DataFrame({key: part[key].to_numpy(), "silhouette": np.where(sizes[mine] == 1, 0.0, (outside - inside) / larger)})

    kind = df.schema[key].dataType.simpleString()
    return drawn.mapInPandas(measure, f"`{key}` {kind}, silhouette double")


def euclidean_silhouette(df: DataFrame, features: str, cluster: str, sample: int = SAMPLE_POINTS, seed: int = 0) -> Silhouette:
    """Mean silhouette of a sample on plain Euclidean distances, with its standard error."""
    found = euclidean_point_silhouettes(df.withColumn("__place", F.lit(0)), "__place", features, cluster, sample, seed)
    row = found.agg(F.avg("silhouette").alias("m"), F.stddev_samp("silhouette").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return Silhouette(row["m"], (row["s"] or 0.0) / math.sqrt(row["n"]), row["n"])

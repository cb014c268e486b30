"""Text embeddings with a cache, and their stored form."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.preparation import apply_pca, fit_pca
from tidemark.session import opened, written

# An embedder turns a series of texts into a series of vectors.
Embedder = Callable[[pd.Series], pd.Series]

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("text_hash", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)
WORD = re.compile(r"\w+")


def hashing_embedder(dimensions: int = 64) -> Embedder:
    """Word counts hashed to signed dimensions, scaled to length 1; needs no service."""

    def embed(texts: pd.Series) -> pd.Series:
        vectors = []
        for text in texts:
            vector = np.zeros(dimensions, dtype=np.float32)
            for word in WORD.findall((text or "").lower()):
                code = zlib.crc32(word.encode())
                vector[(code >> 1) % dimensions] += 1.0 if code & 1 else -1.0
            length = float(np.sqrt((vector * vector).sum()))
            vectors.append(vector / length if length else vector)
        return pd.Series(vectors)

    return embed


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table; an absent one starts empty."""
    return opened(spark, path, CACHE_SCHEMA)


def embed_cached(
    df: DataFrame, text: str, model: str, cache_path: str, embedder: Embedder
) -> tuple[DataFrame, int]:
    """``df`` with an ``embedding`` column, and how many texts were embedded anew.

    Each distinct uncached text is embedded once and appended to the cache before the
    rows are joined back on the text hash; copies of one text share the vector.
    """
    spark = df.sparkSession
    cache = read_cache(spark, cache_path).filter(F.col("model") == model)
    hashed = df.withColumn("text_hash", text_hash(F.col(text)))
    vectors = F.pandas_udf(embedder, "array<float>")
    missing = (
        hashed.filter(F.col(text).isNotNull())
        .join(cache.select("text_hash"), "text_hash", "left_anti")
        .groupBy("text_hash")
        .agg(F.first(text).alias("_text"))
    )
    fresh = written(
        missing.select("text_hash", F.lit(model).alias("model"), vectors("_text").alias("embedding")),
        "fresh-embeddings",
    )
    added = fresh.count()
    if added:
        fresh.write.mode("append").parquet(cache_path)
    known = read_cache(spark, cache_path).filter(F.col("model") == model)
    # a retried append leaves a text twice in the cache
    known = known.select("text_hash", "embedding").dropDuplicates(["text_hash"])
    return (
        hashed.join(known, "text_hash", "left").drop("text_hash"),
        added,
    )


def embedding_records(df: DataFrame, name: str, embedding: str = "embedding") -> DataFrame:
    """``{file_name, text_embedding: [{embed, code}]}``, code is the position."""
    pairs = F.transform(
        embedding, lambda x, i: F.struct(x.cast("double").alias("embed"), i.alias("code"))
    )
    return df.select(F.col(name).alias("file_name"), pairs.alias("text_embedding"))


def write_embedding_records(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def projection_2d(df: DataFrame, key: str, embedding: str, dimensions: int) -> DataFrame:
    """Two principal components per embedding, for a chart."""
    names = [f"_d{i}" for i in range(dimensions)]
    wide = df.select(
        key, *[F.col(embedding)[i].cast("double").alias(n) for i, n in enumerate(names)]
    )
    return apply_pca(wide, fit_pca(wide, names, 2), [key])

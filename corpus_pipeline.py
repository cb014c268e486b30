"""From raw documents to packed sequences: language, near duplicates, benchmark, personal data, packing.

Every stage reads what the stage before it wrote and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, near, packing, sanitise
from tidemark.llm.common import table
from tidemark.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without text or letters go."""
    return language.keep_identified(docs, language.sample_texts(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id."""
    return near.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, findings replaced by the name of their kind."""
    clean = sanitise.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.packed(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]
#: Language identification parses texts with automata and packing runs a tokenizer: SQL can say neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

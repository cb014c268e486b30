"""Registered queries of the numbered operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import collocations, decontaminate, html_extract, language, lm_score, near, packing, passages, preference, quality, sanitise, toxicity, whitening
from tidemark.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text_hash")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest(F.col("items")).alias("items_sha256"), "contaminated")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    samples = language.sample_texts(docs.filter(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, samples)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    good = table(spark, sf_dir, "labels", "doc_id", "quality").filter("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(docs, good)


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), with_text=False)


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.replaced_answers(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    pairs = preference.preference_pairs(turns).withColumnRenamed("pair_id", "conv_id")
    return pairs.withColumns({c: preference.spans_text(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False).drop("ids")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digest(sanitise.findings(table(spark, sf_dir, "documents", "doc_id", "text")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train(docs.filter(~toxicity.held_out(F.col("doc_id"))), labels)
    found = toxicity.score(docs, model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_near": op2_near,
    "op3_html": op3_html,
    "op4_decontaminate": op4_decontaminate,
    "op5_language": op5_language,
    "op6_lm_score": op6_lm_score,
    "op7_passages": op7_passages,
    "op8_preference": op8_preference,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_phrases": op12_phrases,
    "op13_toxicity": op13_toxicity,
}

"""Benchmark decontamination: windows of benchmark words are a broadcast hash set that the windows of every document are looked up in.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one. The set is
a table of marks by the hash of a window's first and last word; it has a fixed greatest size
and goes to every task. A document's windows whose mark is set are few: they are spelled out,
verified against the benchmark's windows by their words in a join, and merged to spans. One
scan splits every text once, whatever the size of the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

WINDOW = 10
#: Marks of the hash set, at least and at most, one byte each, and how many there are per window in
#: between. A fuller table lets more windows through to the verification and none by.
LEAST_MARKS, MOST_MARKS, MARKS_PER_WINDOW = 1 << 16, 1 << 22, 16
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters of ``_NO_WORD``.
_APART = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum() or chr(c).isupper())


def item_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters and digits and of everything beyond ASCII; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    inner = F.btrim(lowered, F.lit(_APART))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _NO_WORD + "+"))


def _gram(words: Column, start: Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _window_starts(n: Column, length: int | Column) -> Column:
    return F.when(n >= length, F.sequence(F.lit(1), n - length + 1)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """Each distinct window of the benchmark with the ids of its items.

    Items without an id or without words have none; repeated items count once.
    """
    rows = items.select(items[id_column].alias("item_id"), item_words(items[text_column]).alias("words")).filter("item_id is not null")
    rows = rows.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    rows = rows.withColumn("start", F.explode(_window_starts(F.size("words"), F.col("length"))))
    ends = F.xxhash64(F.get("words", F.col("start") - 1), F.get("words", F.col("start") + F.col("length") - 2))
    rows = rows.select("item_id", "length", ends.alias("ends"), _gram(F.col("words"), F.col("start"), F.col("length")).alias("gram"))
    return rows.groupBy("length", "gram").agg(F.first("ends").alias("ends"), F.collect_set("item_id").alias("items"))


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id and text of each row, and a hash that tells apart rows that share an id."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.withColumn("text_hash", F.xxhash64("text"))


def scanned(docs: DataFrame, grams: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """Every row as ``doc_id``, ``text_hash``, ``n_words`` and its ``likely`` windows (``start`` from 1, ``length``, ``gram``), stored."""
    facts = grams.agg(F.count("*").alias("n"), F.collect_set("length").alias("lengths")).first()
    size = min(MOST_MARKS, max(LEAST_MARKS, 1 << (MARKS_PER_WINDOW * facts["n"]).bit_length()))
    marks = bytearray(size)
    for row in grams.select(F.pmod("ends", F.lit(size)).alias("at")).distinct().toLocalIterator():
        marks[row["at"]] = 1
    table = F.lit(bytes(marks))
    rows = keyed(docs, id_column, text_column)
    rows = rows.select("doc_id", "text_hash", item_words(F.col("text")).alias("words"))

    def likely(length: int) -> Column:
        def marked(start: Column) -> Column:
            ends = F.xxhash64(F.get("words", start - 1), F.get("words", start + (length - 2)))
            return F.substring(table, F.pmod(ends, F.lit(size)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01")

        starts = F.filter(_window_starts(F.size("words"), length), marked)
        return F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(length).alias("length"), _gram(F.col("words"), s, length).alias("gram")))

    found = [likely(n) for n in sorted(facts["lengths"]) or [window]]
    found = F.flatten(F.array(*found)) if len(found) > 1 else found[0]
    return written(rows.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), found.alias("likely")), "scanned")


def hits(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """Per document with a hit: ``hit_id``, ``hit_hash``, merged ``spans`` of hit words (``start`` from 1, ``end`` inclusive), ``items``.

    Only likely windows of scanned rows move; a document's hits are merged in one task, in order.
    """
    each = rows.select("doc_id", "text_hash", F.explode("likely").alias("w")).select("doc_id", "text_hash", "w.*")
    each = each.join(grams.select("length", "gram", "items"), ["length", "gram"])
    each = each.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "start", (F.col("start") + F.col("length") - 1).alias("end"), "items").distinct()
    place = Window.partitionBy("hit_id", "hit_hash").orderBy("start", "end")
    reach = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("new", (F.col("start") > F.coalesce(reach, F.lit(-1)) + 1).cast("int"))
    each = each.withColumn("run", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    runs = each.groupBy("hit_id", "hit_hash", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    spans = F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")
    return runs.groupBy("hit_id", "hit_hash").agg(spans, F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def _found(docs: DataFrame, items: DataFrame, id_column: str, text_column: str, window: int) -> tuple[DataFrame, DataFrame]:
    grams = written(benchmark_windows(items, window=window), "windows")
    rows = scanned(docs, grams, id_column, text_column, window)
    return rows, hits(rows, grams)


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``spans``, ``contaminated``.

    Null and empty texts have no words and no hits; repeated rows give repeated results;
    further columns are not read; without benchmark items nothing is hit. The only shuffles
    carry likely windows and narrow rows.
    """
    rows, found = _found(docs, items, id_column, text_column, window)
    both = rows.join(found, rows["doc_id"].eqNullSafe(found["hit_id"]) & (rows["text_hash"].eqNullSafe(found["hit_hash"])), "left")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"] + 1), F.lit(0)).cast("long")
    items_found = F.coalesce(F.array_sort("items"), F.array().cast(found.schema["items"].dataType))
    return both.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"), items_found.alias("items"), "spans", (n_hit > 0).alias("contaminated")
    )


def items_digest(items: Column) -> Column:
    """sha256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ","), 256)


def remove_documents(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without a hit in their text.

    Null and empty texts stay; of repeated rows all stay or go; columns of any name pass
    through; an empty table, or one of benchmark items, removes nothing.
    """
    _, found = _found(docs, items, id_column, text_column, window)
    same = docs[id_column].eqNullSafe(found["hit_id"]) & (F.xxhash64(docs[text_column].cast("string")) == found["hit_hash"])
    return docs.join(found, same, "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, with hit words (and what stands before each) cut from the text.

    Texts without a hit, null and empty ones among them, stay as they are; repeated rows are
    cut each; columns of any name pass through; an empty table gives an empty result.
    """
    _, found = _found(docs, items, id_column, text_column, window)
    text = docs[text_column].cast("string")
    both = docs.join(found, docs[id_column].eqNullSafe(found["hit_id"]) & (F.xxhash64(text) == found["hit_hash"]), "left")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    steps = F.regexp_extract_all(text, F.lit(rf"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*{word}+"), 0)
    kept = F.filter(steps, lambda _, i: ~F.exists(found["spans"], lambda s: (i + 1 >= s["start"]) & (i + 1 <= s["end"])))
    left = F.concat(F.array_join(kept, ""), F.regexp_extract(text, rf"(?<={word})[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0))
    return both.select(*(F.when(found["spans"].isNull(), docs[c]).otherwise(left).alias(c) if c == text_column else docs[c] for c in docs.columns))

"""Information-theoretic sanitisation of personal data.

Patterns find protected entities (e-mail and network addresses, cards, phones). Words near
an entity are counted against it over the whole corpus: a word that leaves at most
``MAX_BITS`` bits of doubt about which entity it belongs to, ``-log2 P(entity | word)``, and
that was seen with it in ``MIN_TEXTS`` different texts, discloses it and is found wherever
it occurs. ``sanitised`` replaces each finding by the name of its kind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import keyed
from tidemark.session import written

KINDS = ["email", "ip", "card", "phone", "term"]
MAX_BITS, MIN_TEXTS, NEAR_CHARS = 1.0, 3, 60
#: Terms that may be broadcast, short words each; more are met by a shuffled join.
BROADCAST_TERMS = 200_000
#: The search starts only where a match can start (after a match or a character it can't hold),
#: and no quantifier gives back what it took, so a text is read once however long its words are.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What every match holds; texts without it are not searched.
HINTS = {"email": r"@", "ip": r"\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
_WORD = r"[\p{L}\p{N}]"
_SPAN = "array<struct<start:int,end:int,kind:string,value:string>>"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(r"^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def found(text: Column, pattern: Column, kind: str, value=lambda match: match) -> Column:
    """Valid matches of a pattern with code point offsets, end exclusive.

    Offsets come from the lengths of the matches and of what lies between them.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    parts = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, pattern, 0).alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(done: Column, part: Column) -> Column:
        begin = done["at"] + part["gap"]
        end = begin + F.length(part["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), value(part["match"]).alias("value"))
        good = part["match"].isNotNull() & _valid(kind, part["match"])
        return F.struct(F.coalesce(end, begin).alias("at"), F.when(good, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(parts, start, step, lambda done: done["spans"])


def base_spans(text: Column) -> Column:
    """Spans of the four pattern kinds, each kind's in order."""
    none = F.array().cast(_SPAN)
    return F.concat(*(F.when(text.rlike(HINTS[k]), found(text, F.lit(p), k)).otherwise(none) for k, p in PATTERNS.items()))


def ordered(spans: Column) -> Column:
    """Spans by start, then by kind as listed in ``KINDS``."""
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    keys = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keys)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of ordered spans, joined by commas."""
    return F.array_join(F.transform(ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def text_terms(text: Column) -> Column:
    """Distinct lower-cased words of letters and digits, three characters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD + "{3,}"), 0))


def _near_terms(text: Column, span: Column) -> Column:
    """Words within ``NEAR_CHARS`` of a span, without half words at the far ends."""
    before = F.substring(text, F.greatest(span["start"] + 1 - NEAR_CHARS, F.lit(1)), F.least(span["start"], F.lit(NEAR_CHARS)))
    before = F.when(span["start"] > NEAR_CHARS, F.regexp_replace(before, f"^{_WORD}+", "")).otherwise(before)
    after = F.substring(text, span["end"] + 1, F.lit(NEAR_CHARS))
    after = F.when(F.length(after) == NEAR_CHARS, F.regexp_replace(after, rf"{_WORD}+\z", "")).otherwise(after)
    return F.array_distinct(F.concat(text_terms(before), text_terms(after)))


def disclosing_terms(rows: DataFrame) -> DataFrame:
    """Words that disclose an entity: ``term``, ``bits`` of doubt left.

    ``rows`` has ``text`` and ``text_hash``. All counts cover all rows; only counts are shuffled.
    """
    hot = rows.withColumn("spans", base_spans(F.col("text"))).filter(F.size("spans") > 0)
    hot = hot.select("text", "text_hash", F.explode("spans").alias("span"))
    value = F.lower(F.concat_ws(":", "span.kind", "span.value"))
    pairs = hot.select("text_hash", F.xxhash64(value).alias("entity"), F.explode(_near_terms(F.col("text"), F.col("span"))).alias("term"))
    pairs = written(pairs.filter(~F.col("term").rlike("^[0-9]+$")).distinct(), "near-terms")
    # a word near many entities is in at least as many texts: most words go here, before the corpus is counted
    most = pairs.groupBy("term", "entity").agg(F.count("*").alias("texts")).groupBy("term").agg(F.max("texts").alias("together"))
    some = pairs.select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("texts"))
    near = most.join(some, "term").filter((F.col("together") >= MIN_TEXTS) & (F.log2(F.col("texts") / F.col("together")) <= MAX_BITS))
    near = written(near.select("term", "together"), "near-terms")
    # how many different texts hold the word at all: copies of a text are one witness
    counted = _with_terms(rows, near).select("term", "together", "text_hash").distinct()
    totals = counted.groupBy("term").agg(F.count("*").alias("texts"), F.max("together").alias("together"))
    bits = F.log2(F.col("texts") / F.col("together"))
    return totals.select("term", bits.alias("bits")).filter(F.col("bits") <= MAX_BITS)


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Each row once per word of ``terms`` that its text holds; the words are broadcast while they are few."""
    few = terms.count() <= BROADCAST_TERMS
    held = rows.select(*(c for c in rows.columns if c != "text"), F.explode(text_terms(F.col("text"))).alias("term"))
    return held.join(F.broadcast(terms) if few else terms, "term")


def held_terms(rows: DataFrame) -> DataFrame:
    """The disclosing words of each text that has any: ``doc_id``, ``text_hash``, ``terms``."""
    terms = written(disclosing_terms(rows), "terms")
    held = _with_terms(rows, terms.select("term")).select("doc_id", "text_hash", "term").distinct()
    return held.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _marked(text: Column, terms: Column) -> Column:
    """Spans of some words of a text, whichever case."""
    each = lambda t: found(text, F.concat(F.lit(rf"(?iu)(?<!{_WORD})"), t, F.lit(rf"(?!{_WORD})")), "term")
    return F.coalesce(F.flatten(F.transform(terms, each)), F.array().cast(_SPAN))


def findings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``text``, ``base`` and ``terms`` (arrays of spans).

    Words inside a pattern's span are not reported again. Null and empty texts have no spans;
    repeated rows give repeated results; further columns are not read.
    """
    rows = keyed(docs, id_column, text_column)
    terms = held_terms(rows).withColumnsRenamed({"doc_id": "t_id", "text_hash": "t_hash"})
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("base", base_spans(F.col("text")))
    both = rows.join(terms, rows["doc_id"].eqNullSafe(terms["t_id"]) & (rows["text_hash"] == terms["t_hash"]), "left")
    apart = lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))
    marked = F.when(F.col("terms").isNull(), F.array().cast(_SPAN)).otherwise(F.filter(_marked(F.col("text"), F.col("terms")), apart))
    return both.select("doc_id", "text", "base", marked.alias("terms"))


def digest(found_rows: DataFrame) -> DataFrame:
    """Counts, the sha256 of the pattern spans, and all spans spelled out."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.concat("base", "terms")
    return found_rows.select(
        "doc_id", *(n(k) for k in PATTERNS), F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(every).alias("spans"), F.size("terms").cast("long").alias("n_terms")
    )


def _replaced(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        new = F.concat(done["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["start"] >= done["at"], new).otherwise(done["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with every finding replaced by the name of its kind.

    Null texts stay null, empty ones empty; repeated rows are replaced each; where findings
    overlap the first by start, then kind, names them all; columns of any name pass through; an
    empty table gives an empty result.
    """
    terms = held_terms(keyed(docs, id_column, text_column)).select(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"), F.col("terms").alias("t_terms"))
    text = docs[text_column].cast("string")
    both = docs.join(terms, docs[id_column].eqNullSafe(terms["t_id"]) & (F.xxhash64(text) == terms["t_hash"]), "left")
    marked = F.when(terms["t_terms"].isNull(), F.array().cast(_SPAN)).otherwise(_marked(text, terms["t_terms"]))
    spans = ordered(F.concat(base_spans(text), marked))
    new = F.when(F.size(spans) > 0, _replaced(text, spans)).otherwise(text)
    return both.select(*(new.alias(c) if c == text_column else docs[c] for c in docs.columns))

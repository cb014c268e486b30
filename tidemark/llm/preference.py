"""Preference formatting: one prompt, two masked completions.

The turns that a chosen and a rejected conversation share from their start are rendered once
as the prompt; what follows in each is its completion. Masks are character spans of the
completion that a loss may look at: what the assistant says, with its end marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"
_SPANS = "array<struct<start:int,end:int>>"


def _plain(text: Column) -> Column:
    """A text that cannot be taken for a marker; empty for null."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _rendered(turn: Column) -> Column:
    return F.concat(_head(turn), turn["text"], F.lit(CLOSE + "\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _learned(turns: Column) -> Column:
    """Spans of the rendered turns that are learned, end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        begin = done["at"] + F.length(_head(turn))
        end = begin + F.length(turn["text"]) + len(CLOSE)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(turn["role"] == LEARNED, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda done: done["spans"])


def preference_pairs(turns: DataFrame, pair_column: str = "pair_id") -> DataFrame:
    """One row per pair: its id, ``n_prompt_turns``, ``prompt``, ``chosen``, ``rejected``, ``chosen_spans``, ``rejected_spans``, ``usable``.

    ``turns`` has the pair, ``side`` (``chosen`` or ``rejected``), ``turn``, ``role`` and
    ``text``. Turns are ordered by number, then role, then text; a null number comes first, a
    null text is empty, a null role has no name. Turns are shared if role and text are equal.
    A pair is usable if both completions have something to learn: a side that is missing,
    or that the other one goes on from, leaves it unusable, and the row stays. Repeated rows
    are repeated turns; further columns are not read. One shuffle by pair, of the size of its
    conversations.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), _plain(F.col("text")).alias("text"))
    side = lambda name: F.array_sort(F.collect_list(F.when(F.col("side") == name, turn))).alias(name)
    pairs = turns.groupBy(F.col(pair_column).alias("pair_id")).agg(side("chosen"), side("rejected"))
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    alike = F.zip_with("chosen", "rejected", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    broke = F.array_position(alike, F.lit(False)).cast("int")
    pairs = pairs.withColumn("n_prompt_turns", F.when(broke > 0, broke - 1).otherwise(shorter))
    rest = lambda name: F.slice(name, F.col("n_prompt_turns") + 1, F.greatest(F.size(name), F.lit(1)))
    pairs = pairs.withColumns({"prompt_turns": F.slice("chosen", F.lit(1), F.col("n_prompt_turns")), "c": rest("chosen"), "r": rest("rejected")})
    out = pairs.select(
        "pair_id", "n_prompt_turns", _render(F.col("prompt_turns")).alias("prompt"), _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
        _learned(F.col("c")).alias("chosen_spans"), _learned(F.col("r")).alias("rejected_spans"),
    )
    return out.withColumn("usable", (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0)).withColumnRenamed("pair_id", pair_column)


def replaced_answers(conversations: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Turns of preference pairs made from plain conversations: ``pair_id``, ``side``, ``turn``, ``role``, ``text``.

    Chosen is a conversation up to its last assistant turn; rejected is the same with that
    turn's text taken from the conversation whose id differs in the last bit. Where the partner
    is absent or has no answer, rejected ends before the answer; a conversation without an
    answer is whole on both sides. So every conversation, one with a null id too, has a pair,
    usable or not. A turn with a null number comes before all others; of answers with one
    number the greatest text is the last; repeated rows are repeated turns, and a repeated
    answer is replaced each time. Empty and null texts are answers like others; further columns
    are not read; an empty table has no pairs.
    """
    turns = conversations.select(conversations[id_column].alias("pair_id"), *(conversations[c].alias(c) for c in ("turn", "role", "text")))
    last = turns.filter(F.col("role") == LEARNED).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    own = last.select(F.col("pair_id").alias("own_id"), F.col("last").alias("own"))
    other = last.filter("pair_id is not null").select(F.col("pair_id").bitwiseXOR(1).alias("other_id"), F.col("last").alias("other"))
    both = turns.join(own, turns["pair_id"].eqNullSafe(own["own_id"]), "left").join(other, turns["pair_id"] == other["other_id"], "left")
    said = both.filter(F.col("own").isNull() | F.col("turn").isNull() | F.coalesce(F.col("turn") <= F.col("own.turn"), F.lit(False)))
    final = F.col("own").isNotNull() & F.col("role").eqNullSafe(LEARNED) & F.col("turn").eqNullSafe(F.col("own.turn")) & F.col("text").eqNullSafe(F.col("own.text"))
    chosen = F.struct(F.lit("chosen").alias("side"), F.col("text").alias("said"))
    rejected = F.struct(F.lit("rejected").alias("side"), F.when(final, F.col("other.text")).otherwise(F.col("text")).alias("said"))
    sides = F.when(final & F.col("other").isNull(), F.array(chosen)).otherwise(F.array(chosen, rejected))
    return said.select("pair_id", "turn", "role", F.explode(sides).alias("s")).select("pair_id", "s.side", "turn", "role", F.col("s.said").alias("text"))


def spans_text(spans: Column) -> Column:
    """``start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Ordered text rules: the first rule whose words occur in the text names the bucket."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    bucket: str
    any_of: tuple[str, ...]
    none_of: tuple[str, ...] = ()


# Fixed values.
GAME_RULES = (
    Rule("slots", ("slot",)),
    Rule("roulette", ("ruleta", "roulette")),
    Rule("blackjack", ("blackjack", "black jack")),
)
SPORT_RULES = (
    Rule("football", ("football", "soccer"), none_of=("1025083526",)),
    Rule("tennis", ("tennis",)),
    Rule("baseball", ("baseball",)),
    Rule("basketball", ("basketball",)),
    Rule("greyhounds", ("greyhound",)),
    Rule("horses", ("horse",)),
    Rule("hockey", ("hockey",)),
    Rule("rugby", ("rugby",)),
    Rule("american_football", ("1025083526",)),
    Rule("boxing", ("box",)),
    Rule("volleyball", ("volleyball",)),
)
CHANNEL_RULES = (
    Rule("mobile", ("mobile",)),
    Rule("desktop", ("desktop",)),
    Rule("retail", ("retail",)),
)


def first_match(
    text: Column, rules: Sequence[Rule], default: str, ignore_case: bool = True
) -> Column:
    """Bucket of the first matching rule; null text falls to the default."""
    subject = F.lower(text) if ignore_case else text

    def holds(rule: Rule) -> Column:
        hit = reduce(or_, [subject.contains(word) for word in rule.any_of])
        for word in rule.none_of:
            hit = hit & ~subject.contains(word)
        return hit

    first, *rest = rules
    chain = F.when(holds(first), first.bucket)
    for rule in rest:
        chain = chain.when(holds(rule), rule.bucket)
    return chain.otherwise(default)


def game_bucket(text: Column) -> Column:
    return first_match(text, GAME_RULES, "other")


def sport_bucket(text: Column) -> Column:
    return first_match(text, SPORT_RULES, "other")


def channel_bucket(text: Column) -> Column:
    return first_match(text, CHANNEL_RULES, "missing", ignore_case=False)


def when_channel(channel: Column, wanted: str, measure: Column) -> Column:
    """``measure`` for rows of one source channel, 0 for all others."""
    return F.when(channel == wanted, measure).otherwise(F.lit(0))

"""Rows sent to a queue in small batches through a pluggable sender."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written
from tidemark.sources.rows import rows_to_json

# A sender takes the entries of one batch and returns the ids of those that failed.
Entry = dict[str, str]
Sender = Callable[[list[Entry]], Iterable[str]]

BATCH_SIZE = 10
OUTCOME = "batch_no long, sent long, received long, failed long"


class NotAllSent(RuntimeError):
    """Some messages did not arrive."""


def _entries(rows: list[tuple[str, str]]) -> list[Entry]:
    """Entries numbered within their batch; the key hangs on the row's place and is the same on every retry."""
    return [
        {
            "Id": str(number),
            "MessageBody": body,
            "DeduplicationId": hashlib.sha256(f"{place}\n{body}".encode()).hexdigest(),
        }
        for number, (body, place) in enumerate(rows)
    ]


def send_batches(
    df: DataFrame, open_sender: Callable[[], Sender], batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Send each row as JSON; one outcome row per batch.

    The rows are written first, so each has a fixed place. Each task opens one sender and
    fills its batches across Arrow blocks. A retried task sends again: receivers drop repeats
    by ``DeduplicationId``, which equal rows do not share. Write or aggregate the outcome
    once, every evaluation sends.
    """

    def send(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sender, waiting, number = open_sender(), [], 0

        def flush(rows: list[tuple[str, str]]) -> pd.DataFrame:
            entries = _entries(rows)
            failed = len(set(sender(entries)))
            return pd.DataFrame(
                [[number, len(entries), len(entries) - failed, failed]],
                columns=["batch_no", "sent", "received", "failed"],
            )

        for block in blocks:
            waiting.extend(zip(block["row"], block["place"], strict=True))
            while len(waiting) >= batch_size:
                rows, waiting = waiting[:batch_size], waiting[batch_size:]
                yield flush(rows)
                number += 1
        if waiting:
            yield flush(waiting)

    place = F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias("place")
    return written(rows_to_json(df, "row"), "messages").select("row", place).mapInPandas(send, OUTCOME)


def delivery_totals(outcome: DataFrame) -> DataFrame:
    """``sent``, ``received`` and ``failed`` over all batches."""
    return outcome.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sent", "received", "failed")]
    )


def send_rows(
    df: DataFrame, open_sender: Callable[[], Sender], batch: bool = True, batch_size: int = BATCH_SIZE
) -> dict[str, int]:
    """Send all rows and return the totals; single mode raises when any row failed."""
    outcome = send_batches(df, open_sender, batch_size if batch else 1)
    totals = delivery_totals(outcome).first().asDict()
    if not batch and totals["failed"]:
        raise NotAllSent(f"{totals['failed']} of {totals['sent']} rows were not sent")
    return totals

"""Look-back and look-ahead windows for many reference dates in one pass.

The ends of all windows cut time into panes: single moments where a window ends, and what
lies between two of them. A window is a run of panes, so rows are first combined by pane,
once, and the combined rows go to every date whose window covers the pane
(``with_panes``, ``dates_of_panes``). Where single rows are wanted per date,
``rows_per_date`` gives one copy of a row per covering date. Rows meet panes and dates
through an equality on the calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



class Window(NamedTuple):
    """Days before and after a reference date, with the ends that count."""

    days_before: int
    days_after: int = 0
    closed: str = "both"  # "both", "right" (start excluded), "left" (end excluded)


def as_moment(value: str | date | datetime) -> datetime:
    """A reference date as a naive UTC datetime."""
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def moment_literal(value: datetime, data_type: T.DataType = T.TimestampType()) -> Column:
    """A literal of the column's own type, so that comparing needs no cast."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(data_type)


def _scan_ranges(dates: Sequence[datetime], window: Window) -> list[tuple[datetime, datetime]]:
    """Union of all windows as disjoint ranges."""
    spans = sorted(
        (d - timedelta(days=window.days_before), d + timedelta(days=window.days_after))
        for d in dates
    )
    merged: list[tuple[datetime, datetime]] = []
    for low, high in spans:
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def scan_filter(
    df: DataFrame, time_col: str, dates: Sequence[datetime], window: Window, day_col: str | None = None
) -> DataFrame:
    """Keep rows inside the union of the windows; plain literals reach the file scan.

    ``day_col`` is a partition column with the day of ``time_col``: the same bounds on it leave
    whole partitions unread.
    """
    data_type = df.schema[time_col].dataType
    column = F.col(time_col)
    by_day = isinstance(data_type, T.DateType)
    ranges = []
    for low, high in _scan_ranges(dates, window):
        if by_day:
            ranges.append(column.between(F.lit(low.date()), F.lit(high.date())))
        else:
            ranges.append(
                column.between(moment_literal(low, data_type), moment_literal(high, data_type))
            )
    kept = df.filter(reduce(or_, ranges))
    if day_col is None:
        return kept
    days = [F.col(day_col).between(F.lit(low.date()), F.lit(high.date())) for low, high in _scan_ranges(dates, window)]
    return kept.filter(reduce(or_, days))


def day_table(
    spark: SparkSession, dates: Sequence[datetime], window: Window
) -> DataFrame:
    """One row ``(window_day, statsdates)`` per covered day: the calendar bounds it, so it is broadcast."""
    statsdates = F.array(*[moment_literal(d) for d in dates])
    days = (
        spark.range(1)
        .select(F.explode(statsdates).alias("statsdate"))
        .select(
            "statsdate",
            F.explode(
                F.sequence(
                    F.date_sub(F.to_date("statsdate"), window.days_before),
                    F.date_add(F.to_date("statsdate"), window.days_after),
                )
            ).alias("window_day"),
        )
    )
    return F.broadcast(days.groupBy("window_day").agg(F.sort_array(F.collect_list("statsdate")).alias("statsdates")))


def rows_per_date(
    df: DataFrame,
    time_col: str,
    dates: Sequence[str | date | datetime],
    window: Window,
    day_col: str | None = None,
) -> DataFrame:
    """``df`` with a ``statsdate`` column, one copy of a row per date that covers it.

    ``time_col`` is a timestamp (bounds are exact to the microsecond) or a date
    (bounds are whole days, both ends in). ``day_col`` names the partition column of a table
    stored by the day of ``time_col``, if it is.
    """
    moments = sorted({as_moment(d) for d in dates})
    if not moments:
        raise ValueError("no reference dates")
    by_day = isinstance(df.schema[time_col].dataType, T.DateType)
    moment = F.col(time_col)
    joined = (
        scan_filter(df, time_col, moments, window, day_col)
        .withColumn("window_day", moment if by_day else F.to_date(moment))
        .join(day_table(df.sparkSession, moments, window), "window_day")
        .withColumn("statsdate", F.explode("statsdates"))
        .drop("window_day", "statsdates")
    )
    if by_day:
        return joined
    moment = moment.cast("timestamp")
    low = F.col("statsdate") - F.make_dt_interval(F.lit(window.days_before))
    high = F.col("statsdate") + F.make_dt_interval(F.lit(window.days_after))
    after = moment > low if window.closed == "right" else moment >= low
    before = moment < high if window.closed == "left" else moment <= high
    return joined.filter(after & before)


PANE = ("pane_day", "pane")


def _window_ends(moments: Sequence[datetime], window: Window) -> list[tuple[datetime, datetime, datetime]]:
    """First moment, reference date and last moment of each window."""
    return [(d - timedelta(days=window.days_before), d, d + timedelta(days=window.days_after)) for d in moments]


def _covers(low: datetime, high: datetime, moment: datetime, closed: str) -> bool:
    after = low < moment if closed == "right" else low <= moment
    return after and (moment < high if closed == "left" else moment <= high)


def _ends_by_day(moments: Sequence[datetime], window: Window) -> dict[date, list[datetime]]:
    """The window ends of every day that a window touches, in order."""
    by_day: dict[date, set[datetime]] = {}
    for low, middle, high in _window_ends(moments, window):
        for k in range((high.date() - low.date()).days + 1):
            by_day.setdefault(low.date() + timedelta(days=k), set())
        for end in (low, middle, high):
            by_day[end.date()].add(end)
    return {day: sorted(ends) for day, ends in by_day.items()}


def with_panes(df: DataFrame, time_col: str, dates: Sequence[str | date | datetime], window: Window, day_col: str | None = None) -> DataFrame:
    """The rows inside any window, each once, with its pane as ``pane_day`` and ``pane``.

    A pane is a calendar day, or a part of one where windows end inside it: pane ``2 k`` comes
    after ``k`` window ends of the day, pane ``2 k + 1`` is the moment of the next one. So a
    row is in a window if its pane is, to the microsecond. ``time_col`` and ``day_col`` are as
    in ``rows_per_date``; rows with a null time are in no window.
    """
    moments = sorted({as_moment(d) for d in dates})
    if not moments:
        raise ValueError("no reference dates")
    kept = scan_filter(df, time_col, moments, window, day_col)
    moment = F.col(time_col)
    if isinstance(df.schema[time_col].dataType, T.DateType):
        return kept.withColumns({"pane_day": moment, "pane": F.lit(0)})
    by_day = _ends_by_day(moments, window)
    width = max(map(len, by_day.values()))
    rows = [(day.isoformat(), *(str(e) for e in ends), *[None] * (width - len(ends))) for day, ends in sorted(by_day.items())]
    names = [f"__end_{i}" for i in range(width)]
    table = df.sparkSession.createDataFrame(rows, ", ".join(["__day string", *(f"{n} string" for n in names)]))
    table = F.broadcast(table.select(F.col("__day").cast("date").alias("pane_day"), *(F.col(n).cast("timestamp") for n in names)))
    at = moment.cast("timestamp")
    passed = [F.when(at > F.col(n), 2).when(at == F.col(n), 1).otherwise(0) for n in names]
    joined = kept.withColumn("pane_day", F.to_date(moment)).join(table, "pane_day")
    return joined.select(*(kept[c] for c in df.columns), "pane_day", reduce(lambda a, b: a + b, passed).alias("pane"))


def _pane_dates(moments: Sequence[datetime], window: Window, by_day: bool) -> list[tuple[str, int, str, bool]]:
    """Every pane with every date whose window covers it, and whether the date is not before it."""
    spans, out = _window_ends(moments, window), []
    if by_day:
        for low, middle, high in spans:
            days = [low.date() + timedelta(days=k) for k in range((high.date() - low.date()).days + 1)]
            out += [(day.isoformat(), 0, str(middle), day <= middle.date()) for day in days]
        return out
    tick = timedelta(microseconds=1)
    for day, ends in _ends_by_day(moments, window).items():
        start = datetime(day.year, day.month, day.day)
        edges = [start - tick, *ends, start + timedelta(days=1)]
        panes = [(2 * k + 1, end) for k, end in enumerate(ends)]
        # any moment between two ends stands for all of them
        panes += [(2 * k, a + tick) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b - a > tick]
        for low, middle, high in spans:
            if low.date() <= day <= high.date():
                out += [(day.isoformat(), pane, str(middle), at <= middle) for pane, at in panes if _covers(low, high, at, window.closed)]
    return out


def dates_of_panes(panes: DataFrame, dates: Sequence[str | date | datetime], window: Window, by_day: bool = False) -> DataFrame:
    """Rows combined by pane, one copy per date whose window covers the pane: with ``statsdate`` and ``is_back``.

    ``is_back`` tells panes up to the date from panes after it. The calendar bounds the
    broadcast table: one row per pane, with its dates. ``by_day`` says that the panes are whole days.
    """
    moments = sorted({as_moment(d) for d in dates})
    table = panes.sparkSession.createDataFrame(_pane_dates(moments, window, by_day), "__day string, pane int, statsdate string, is_back boolean")
    covering = F.collect_list(F.struct(F.col("statsdate").cast("timestamp").alias("statsdate"), "is_back")).alias("__dates")
    table = table.groupBy(F.col("__day").cast("date").alias("pane_day"), "pane").agg(covering)
    joined = panes.join(F.broadcast(table), list(PANE))
    others = [c for c in panes.columns if c not in PANE]
    return joined.select(*others, F.explode("__dates").alias("__date")).select(*others, "__date.statsdate", "__date.is_back")


def union_of(sets: Column) -> Column:
    """Distinct values of several collected sets."""
    return F.array_distinct(F.flatten(F.collect_list(sets)))


def listed(values: Column, separator: str = ",") -> Column:
    """Values of an array as one sorted text; null when there is none."""
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), separator))


def distinct_list(value: Column, separator: str = ",") -> Column:
    """Distinct non-null values as one sorted text; null when there is none."""
    values = F.collect_set(value)
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), separator))


def distinct_count(value: Column) -> Column:
    """Distinct non-null values of a column that a window bounds (hours, days).

    The set travels inside the aggregate, so the group needs one shuffle and no
    row expansion per distinct column.
    """
    return F.size(F.collect_set(value)).cast("long")


def last_date(df: DataFrame, value_col: str, time_col: str, as_of: datetime, days: int = 14) -> DataFrame:
    """Latest ``value_col`` among rows not older than ``days`` before ``as_of``."""
    data_type = df.schema[time_col].dataType
    recent = F.col(time_col) >= moment_literal(as_of - timedelta(days=days), data_type)
    return df.filter(recent).agg(F.max(value_col).alias("last_date"))


def backfill_range(
    last: datetime | None,
    stats_lookback: int = 365,
    churn_period: int = 7,
    date_from: str | None = None,
    date_to: str | None = None,
) -> tuple[datetime, datetime]:
    """Range ``[from, to)`` of candidate dates: explicit, or counted back from ``last``."""
    if date_from and date_to:
        return as_moment(date_from), as_moment(date_to)
    if last is None:
        raise ValueError("no recent data to count the range back from")
    return last - timedelta(days=stats_lookback), last - timedelta(days=churn_period)


def sample_dates(
    spark: SparkSession, start: datetime, stop: datetime, points: int, seed: int = 0
) -> DataFrame:
    """``points`` distinct days of ``[start, stop)``, the same ones for the same seed."""
    days = (stop - start).days
    if points > days:
        raise ValueError(f"{points} dates wanted, the range has {days} days")
    return (
        spark.range(days)
        .select(
            (moment_literal(start) + F.make_dt_interval(F.col("id").cast("int"))).alias("statsdate")
        )
        .orderBy(F.xxhash64("statsdate", F.lit(seed)), "statsdate")
        .limit(points)
    )

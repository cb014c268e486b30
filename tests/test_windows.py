"""Windows: exact ends, many dates at once, the plan."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.session import new_location
from tidemark.operators.windows import (
    PANE,
    Window,
    backfill_range,
    distinct_count,
    distinct_list,
    dates_of_panes,
    rows_per_date,
    sample_dates,
    with_panes,
)

D = datetime(2024, 1, 15)


def moments(spark, kind="timestamp"):
    tick = timedelta(microseconds=1)
    rows = [
        (1, D - timedelta(days=7) - tick), (2, D - timedelta(days=7)), (3, D - tick), (4, D),
        (5, D + tick), (6, D + timedelta(days=3)), (7, D + timedelta(days=3) + tick), (8, None),
    ]
    return spark.createDataFrame(
        [(i, None if m is None else m.strftime("%Y-%m-%d %H:%M:%S.%f")) for i, m in rows],
        "id int, text string",
    ).select("id", F.col("text").cast(kind).alias("at"))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    "window, kept",
    [
        (Window(7), [2, 3, 4]),
        (Window(7, closed="right"), [3, 4]),
        (Window(7, closed="left"), [2, 3]),
        (Window(0, 3), [4, 5, 6]),
        (Window(7, 3), [2, 3, 4, 5, 6]),
    ],
)
def test_ends(spark, kind, window, kept):
    rows = rows_per_date(moments(spark, kind), "at", [D], window)
    assert sorted(r["id"] for r in rows.collect()) == kept


def test_whole_days(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in range(6, 18)], "day date")
    rows = rows_per_date(days, "day", ["2024-01-15"], Window(7)).collect()
    assert sorted(r["day"].day for r in rows) == list(range(8, 16))


def test_dates_with_a_time_of_day(spark):
    at = datetime(2024, 1, 15, 13, 30)
    rows = rows_per_date(moments(spark), "at", [at], Window(7))
    assert sorted(r["id"] for r in rows.collect()) == [3, 4, 5]


def test_overlapping_dates_against_brute_force(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    dates = [datetime(2024, 1, d) for d in (8, 9, 12, 25)]
    found = {
        (r["statsdate"], r["event_id"])
        for r in rows_per_date(events, "ts", dates, Window(3, 2)).collect()
    }
    expected = {
        (d, r["event_id"])
        for r in events.collect()
        for d in dates
        if d - timedelta(days=3) <= r["ts"] <= d + timedelta(days=2)
    }
    assert found == expected


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_equality_join_and_pushed_bounds(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(rows_per_date(events, "ts", [D, D + timedelta(days=1)], Window(7)))
    assert "BroadcastHashJoin" in text
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text


def test_no_dates(spark):
    with pytest.raises(ValueError):
        rows_per_date(moments(spark), "at", [], Window(7))


def test_lists_skip_null_and_sort(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "x string")
    row = rows.agg(
        distinct_list(F.col("x")).alias("l"), distinct_count(F.col("x")).alias("n")
    ).first()
    assert (row["l"], row["n"]) == ("a,b", 2)
    assert rows.filter("x is null").agg(distinct_list(F.col("x")).alias("l")).first()["l"] is None


def test_sample_dates(spark):
    start, stop = datetime(2024, 1, 1), datetime(2024, 1, 31)
    first = [r["statsdate"] for r in sample_dates(spark, start, stop, 12, seed=1).collect()]
    assert len(set(first)) == 12 and min(first) >= start and max(first) < stop
    assert first == [r["statsdate"] for r in sample_dates(spark, start, stop, 12, seed=1).collect()]
    assert first != [r["statsdate"] for r in sample_dates(spark, start, stop, 12, seed=2).collect()]
    with pytest.raises(ValueError):
        sample_dates(spark, start, stop, 31)


def test_backfill_range():
    assert backfill_range(D, 30, 7) == (D - timedelta(days=30), D - timedelta(days=7))
    assert backfill_range(None, date_from="2024-01-01", date_to="2024-02-01")[1].month == 2
    with pytest.raises(ValueError):
        backfill_range(None)


def test_partitions_outside_the_windows_are_not_read(spark):
    path = new_location(spark, "by-day")
    rows = spark.range(2000).select("id", (F.timestamp_seconds(F.col("id") * 3600 + 1704067200)).alias("ts"))
    rows.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    dates = ["2024-01-08", "2024-02-20"]
    found = rows_per_date(stored, "ts", dates, Window(3, 2), "day")
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "day" in filters and "2024-01-05" in filters
    same = rows_per_date(stored, "ts", dates, Window(3, 2))
    assert found.count() == same.count() > 0 and found.exceptAll(same).isEmpty()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    "window", [Window(7), Window(7, closed="right"), Window(7, closed="left"), Window(0, 3), Window(7, 3), Window(0), Window(2, 1)]
)
def test_panes_hold_the_rows_of_their_dates(spark, kind, window):
    """Rows combined by pane and then dealt to dates are the rows each date has on its own."""
    tick = timedelta(microseconds=1)
    dates = [D, datetime(2024, 1, 16), datetime(2024, 1, 16, 13, 30), datetime(2024, 1, 16, 13, 30, 0, 1), datetime(2024, 1, 19), D]
    ends = {d + timedelta(days=k) + t for d in dates for k in (-7, -2, 0, 1, 3) for t in (-tick, 0 * tick, tick)}
    moments_ = sorted(ends) + [D + timedelta(hours=7 * k) for k in range(-40, 40)] + [D, D]
    rows = spark.createDataFrame([(i, m.strftime("%Y-%m-%d %H:%M:%S.%f")) for i, m in enumerate(moments_)] + [(-1, None)], "id int, text string")
    rows = rows.select("id", F.col("text").cast(kind).alias("at"))
    panes = with_panes(rows, "at", dates, window)
    assert panes.select("id").distinct().count() == panes.count() and panes.columns == ["id", "at", *PANE]
    sums = panes.groupBy(*PANE).agg(F.collect_list("id").alias("ids"))
    found = sorted((r["statsdate"], i) for r in dates_of_panes(sums, dates, window).collect() for i in r["ids"])
    alone = sorted((r["statsdate"], r["id"]) for r in rows_per_date(rows, "at", dates, window).collect())
    assert found == alone and len(found) > 3
    for r in dates_of_panes(sums, dates, window).collect():
        assert all((moments_[i] <= r["statsdate"]) == r["is_back"] for i in r["ids"])


def test_panes_of_whole_days(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 31)], "day date")
    dates, window = ["2024-01-15", "2024-01-17 12:00:00"], Window(7, 1)
    sums = with_panes(days, "day", dates, window).groupBy(*PANE).agg(F.collect_list("day").alias("days"))
    found = sorted((r["statsdate"], d) for r in dates_of_panes(sums, dates, window, by_day=True).collect() for d in r["days"])
    assert found == sorted((r["statsdate"], r["day"]) for r in rows_per_date(days, "day", dates, window).collect())
    with pytest.raises(ValueError):
        with_panes(days, "day", [], window)


def test_panes_push_their_bounds(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(with_panes(events, "ts", [D, D + timedelta(days=1)], Window(7)))
    assert "GreaterThanOrEqual(ts" in text and "Generate" not in text and "NestedLoop" not in text

"""The churn table on a few hand-made rows."""

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans.churn import (
    OUTPUT_COLUMNS,
    ChurnSources,
    customer_window_agg,
    write_churn_table,
)
from tidemark.session import new_location
from tidemark.sources.warehouse import Warehouse

DATE = datetime(2024, 1, 15)


@pytest.fixture(scope="module")
def sources(spark):
    at = datetime
    customers = spark.createDataFrame(
        [
            (1, at(2024, 1, 1), at(2024, 1, 2), "No", 10.0, "New York", "HOMBRE", "Perú", None, ""),
            (2, at(2024, 1, 1), at(2024, 1, 2), "No", 10.0, "b", "mujer", "x", "web", "a"),
            (3, at(2024, 1, 1), at(2024, 1, 2), "Yes", 10.0, "c", "x", "x", "web", "a"),
            (4, at(2024, 1, 1), at(2024, 1, 15), "No", 10.0, "d", "x", "x", "web", "a"),
            (5, at(2024, 1, 1), at(1900, 1, 1), "No", 10.0, "e", "x", "x", "web", "a"),
            (6, at(2024, 1, 1), at(2024, 1, 2), "No", 0.0, "f", "x", "x", "web", "a"),
        ],
        "idContacto long, regDate timestamp, firstDepositDate timestamp, testAccount string, "
        "tDepositAmt double, partner string, gender string, ResidentCountry string, "
        "regChannel string, mexosAdvertiser string",
    )
    hourly_rows = []
    for key in (1, 3, 4, 5, 6):
        hourly_rows += [
            # Window ends on the local clock count, one hour outside does not.
            (key, "mobile app", at(2024, 1, 8), at(2024, 1, 8), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 1, 1),
            (key, "EMAIL", at(2024, 1, 14, 23), at(2024, 1, 15), None, None, None, None, 0.0, 1.0, 2, 3),
            (key, "SMS", at(2024, 1, 14, 23), at(2024, 1, 14, 23), None, None, None, None, None, 1.0, 5, 7),
            (key, "retail", at(2024, 1, 7, 23), at(2024, 1, 7, 23), 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9, 9),
            # After the date: labels only.
            (key, "desktop", at(2024, 1, 15, 1), at(2024, 1, 15, 1), 0.0, 0.0, 20.0, 0.0, 30.0, None, 0, 0),
            (key, "desktop", at(2024, 1, 22), at(2024, 1, 22), 0.0, 0.0, 2.0, 0.0, 3.0, None, 0, 0),
            (key, "desktop", at(2024, 1, 22, 1), at(2024, 1, 22, 1), 0.0, 0.0, 99.0, 0.0, 99.0, 99.0, 0, 0),
        ]
    # Customer 2 is active only after the date.
    hourly_rows.append((2, "desktop", at(2024, 1, 16), at(2024, 1, 16), 0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0, 0))
    hourly = spark.createDataFrame(
        hourly_rows,
        "idContacto long, channel string, statshour timestamp, localStatshour timestamp, "
        "casinoNGRbaseCur double, sportsbookNGRbaseCur double, depositAmountBaseCur double, "
        "withdrawAmountBaseCur double, betAmountBaseCur double, ticketTurnoverBaseCur double, "
        "promo_open int, promo_click int",
    )
    casino = spark.createDataFrame(
        [
            (1, date(2024, 1, 8), "Video SLOT", 5.0, 1.0),
            (1, date(2024, 1, 15), "Black Jack", 2.0, 4.0),
            (1, date(2024, 1, 7), "Poker", 50.0, 1.0),
            (1, date(2024, 1, 9), "Poker", -1.0, 1.0),
            (1, date(2024, 1, 9), "Poker", None, 1.0),
        ],
        "idContacto long, localDt date, gameCategory string, betAmountBaseCur double, winAmountBaseCur double",
    )
    sports = spark.createDataFrame(
        [
            (1, at(2024, 1, 8), "Tennis", "live", "s", "A", 100.0),  # start is excluded
            (1, at(2024, 1, 8, 0, 0, 1), "Soccer", "live", "s", "A", 1.0),
            (1, at(2024, 1, 9), "Soccer 1025083526", "pre", None, "B", 2.0),
            (1, at(2024, 1, 15), "Volleyball", "pre", "m", "A", 4.0),
            (1, at(2024, 1, 10), "Boxing", "pre", "m", "C", 0.0),
        ],
        "idContacto long, statsdate timestamp, sportName string, isLive string, betType string, "
        "leagueName string, turnoverBaseCur double",
    )
    leagues = spark.createDataFrame(
        [("A", at(2024, 1, 15)), ("A", at(2024, 1, 20)), ("B", at(2024, 1, 22, 0, 0, 1)), ("C", at(2024, 1, 16))],
        "LEAGUENAME string, DEV_STARTDATE timestamp",
    )
    return ChurnSources(customers, casino, hourly, sports, leagues)


def test_row_by_hand(sources):
    table = customer_window_agg(sources, [DATE], 7, 7)
    assert tuple(table.columns) == OUTPUT_COLUMNS
    rows = {r["idContacto"]: r.asDict() for r in table.collect()}
    assert set(rows) == {1}
    row = rows[1]
    expected = {
        "partner": "NewmissingYork", "gender": "M", "country": "Per", "regChannel": "missing",
        "advertiser": "", "cat_regweekday": "weekday_2", "daysSinceReg": 14, "daysSinceFd": 13,
        "channelList": "missing,mobile", "active_hours": 2, "deposit_hours": 1, "deposit": 3.0,
        "ngr_casino": 1.0, "ngr_sports": 2.0, "withdraw": 4.0, "activeLastHour": 0,
        "lastLocalHour": 0, "promo_emails_opened": 2, "promo_emails_clicked": 3,
        "promo_sms_clicked": 7, "casino_bets": 7.0, "casino_wins": 5.0, "casino_gw": 2.0,
        "casino_game_list": "blackjack,slots", "sports_turnover": 7.0,
        "sportsList": "american_football,football,volleyball", "isLiveList": "live,pre",
        "betTypeList": "m,s", "futureLeaguesCnt": 1, "pred_deposit_base_cur": 22.0,
        "pred_casino_bet": 33.0, "pred_sports_bet": None,
    }
    assert {k: row[k] for k in expected} == expected


def test_withdrawal_hours_as_the_original_counts_them(sources):
    row = customer_window_agg(sources, [DATE], 7, 7, as_reference=True).first()
    assert row["deposit_hours"] == 1 and row["deposit"] == 3.0


def test_many_dates_equal_single_runs(sources):
    dates = [DATE, datetime(2024, 1, 9), datetime(2024, 1, 20)]
    together = {tuple(r) for r in customer_window_agg(sources, dates, 7, 7).collect()}
    apart = {tuple(r) for d in dates for r in customer_window_agg(sources, [d], 7, 7).collect()}
    assert together == apart


def test_rerun_replaces_only_its_slice(spark, sources):
    house = Warehouse(spark, f"tm_{uuid.uuid4().hex}", new_location(spark, "warehouse"))
    assert write_churn_table(house, sources, [DATE], 7, 7, "churn") == 1
    assert write_churn_table(house, sources, [DATE], 7, 7, "churn") == 1
    write_churn_table(house, sources, [DATE], 1, 1, "churn")
    table = house.table("churn")
    assert table.filter("days_back = 7").count() == 1
    assert table.filter("days_back = 1").count() == 1
    # A run without rows empties its slice.
    assert write_churn_table(house, sources, [datetime(2023, 1, 1)], 7, 7, "churn") == 0
    assert house.table("churn").filter("days_back = 7").count() == 0
    assert house.table("churn").filter("days_back = 1").count() == 1


def test_plan_has_no_nested_loop(sources):
    text = customer_window_agg(sources, [DATE], 7, 7)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_rows_are_combined_before_they_are_copied_and_dealt_by_customer_once(spark, sources):
    dates = [DATE, datetime(2024, 1, 9), datetime(2024, 1, 20)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = customer_window_agg(sources, dates, 7, 7)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line.split("Exchange ")[1] for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("statsdate" in e for e in exchanges)  # joins and dates need no partitioning of their own
    by_customer = [e for e in exchanges if e.split("(")[1].split("#")[0] == "idContacto" and e.split("(")[1].count("#") == 1]
    assert len(by_customer) == 4  # hourly, casino, sports, customers
    for part in text.split("Generate explode(__dates")[1:]:  # below a copy to dates: rows of a pane, combined and dealt
        assert "HashAggregate" in part.split("Scan")[0] and "Exchange" in part.split("Scan")[0]


def test_dates_of_one_customer_with_times_of_day(sources):
    dates = [datetime(2024, 1, 15, 13, 30), datetime(2024, 1, 15), datetime(2024, 1, 14, 23)]
    together = {tuple(r) for r in customer_window_agg(sources, dates, 3, 2).collect()}
    assert together == {tuple(r) for d in dates for r in customer_window_agg(sources, [d], 3, 2).collect()}

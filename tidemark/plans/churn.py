"""The customer churn window table: look-back features and look-ahead labels.

For every reference date and eligible customer: activity of the last ``days_back``
days, leagues starting soon, and what the customer did in the ``churn_period`` days
after the date. All dates are computed in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import (
    clean_category,
    map_codes,
    null_defaults,
    weekday_category,
    whole_units,
)
from tidemark.functions.rules import channel_bucket, game_bucket, sport_bucket, when_channel
from tidemark.operators.windows import PANE, Window, dates_of_panes, listed, union_of, with_panes
from tidemark.sources.export import counted_write
from tidemark.sources.warehouse import Warehouse

Dates = Sequence[str | date | datetime]
GROUP = ["statsdate", "idContacto"]

# Output columns in table order, and what replaces a missing value.
OUTPUT_COLUMNS = (
    "days_back", "churn_period", "statsdate", "idContacto", "partner", "gender", "country",
    "regChannel", "advertiser", "cat_regweekday", "daysSinceReg", "daysSinceFd",
    "channelList", "sportsList", "active_hours", "deposit_hours", "deposit", "ngr_sports",
    "ngr_casino", "betTypeList", "withdraw", "casino_wins", "casino_game_list",
    "casino_bets", "casino_gw", "futureLeaguesCnt", "isLiveList", "sports_turnover",
    "activeLastHour", "lastLocalHour", "pred_deposit_base_cur", "pred_casino_bet",
    "pred_sports_bet", "promo_emails_opened", "promo_sms_clicked", "promo_emails_clicked",
)
ACTIVITY_DEFAULTS = {
    "active_hours": 0, "channelList": "missing", "deposit_hours": 0, "deposit": 0,
    "ngr_sports": 0, "ngr_casino": 0, "withdraw": 0, "activeLastHour": 0,
    "lastLocalHour": 25, "promo_emails_opened": 0, "promo_sms_clicked": 0,
    "promo_emails_clicked": 0,
}
CASINO_DEFAULTS = {
    "casino_bets": 0, "casino_wins": 0, "casino_gw": 0, "casino_game_list": "missing",
}
SPORTS_DEFAULTS = {
    "sports_turnover": 0, "sportsList": "missing", "isLiveList": "missing",
    "betTypeList": "missing", "futureLeaguesCnt": 0,
}


class ChurnSources(NamedTuple):
    """Input tables.

    customers: idContacto, regDate, firstDepositDate, testAccount, tDepositAmt, partner,
        gender, ResidentCountry, regChannel, mexosAdvertiser
    casino: idContacto, localDt (date), gameCategory, betAmountBaseCur, winAmountBaseCur
    hourly: idContacto, channel, statshour (UTC), localStatshour, casinoNGRbaseCur,
        sportsbookNGRbaseCur, depositAmountBaseCur, withdrawAmountBaseCur,
        betAmountBaseCur, ticketTurnoverBaseCur, promo_open, promo_click
    sports: idContacto, statsdate, sportName, isLive, betType, leagueName, turnoverBaseCur
    league_events: LEAGUENAME, DEV_STARTDATE
    day: partition column of hourly and sports if they are stored by the day of their
        localStatshour and statsdate; partitions outside all windows are then not read
    """

    customers: DataFrame
    casino: DataFrame
    hourly: DataFrame
    sports: DataFrame
    league_events: DataFrame
    day: str | None = None


def _non_null_sum(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(F.coalesce(value, F.lit(0)))


def is_eligible(statsdate: Column) -> Column:
    """Real depositing customers registered and first paid before the date."""
    return (
        (F.col("testAccount") == "No")
        & (F.col("regDate") < statsdate)
        & (F.col("tDepositAmt") > 0)
        & (F.col("firstDepositDate") < statsdate)
        & (F.col("firstDepositDate") > F.lit("1900-01-01").cast("timestamp"))
        & F.col("regDate").isNotNull()
    )


def customer_features(customers: DataFrame) -> DataFrame:
    """Cleaned customer attributes, still free of any reference date."""
    return customers.filter(
        (F.col("testAccount") == "No") & (F.col("tDepositAmt") > 0) & F.col("regDate").isNotNull()
    ).select(
        "idContacto",
        "testAccount",
        "tDepositAmt",
        F.col("regDate").cast("timestamp").alias("regDate"),
        F.col("firstDepositDate").cast("timestamp").alias("firstDepositDate"),
        clean_category(F.col("partner")).alias("partner"),
        map_codes(clean_category(F.col("gender"))).alias("gender"),
        clean_category(F.col("ResidentCountry")).alias("country"),
        clean_category(F.col("regChannel")).alias("regChannel"),
        clean_category(F.col("mexosAdvertiser")).alias("advertiser"),
        weekday_category(F.col("regDate")).alias("cat_regweekday"),
    )


def _by_customer(panes: DataFrame) -> DataFrame:
    """Rows combined by pane, dealt by customer: all that follows (dates, joins) keeps this partitioning."""
    return panes.repartition("idContacto")


def casino_totals(casino: DataFrame, dates: Dates, days_back: int) -> DataFrame:
    """Casino bets, wins and game types over whole days, both ends in."""
    window = Window(days_back)
    playing = casino.filter(F.col("betAmountBaseCur") + F.col("winAmountBaseCur") > 0)
    panes = with_panes(playing, "localDt", dates, window).groupBy("idContacto", *PANE).agg(
        F.sum("betAmountBaseCur").alias("bets"),
        F.sum("winAmountBaseCur").alias("wins"),
        F.collect_set(game_bucket(F.col("gameCategory"))).alias("games"),
    )
    totals = (
        dates_of_panes(_by_customer(panes), dates, window, by_day=True)
        .groupBy(*GROUP)
        .agg(
            F.sum("bets").alias("casino_bets"),
            F.sum("wins").alias("casino_wins"),
            listed(union_of("games")).alias("casino_game_list"),
        )
        .withColumn("casino_gw", F.col("casino_bets") - F.col("casino_wins"))
    )
    return null_defaults(totals, CASINO_DEFAULTS)


def hourly_activity(
    hourly: DataFrame,
    dates: Dates,
    days_back: int,
    churn_period: int,
    deposit_measure: str = "depositAmountBaseCur",
    day: str | None = None,
) -> DataFrame:
    """Look-back activity and look-ahead labels from one scan.

    Look-back covers ``[date - days_back, date]`` and labels ``(date, date +
    churn_period]``, both on the local clock. Labels stay null without rows.
    Dates without look-back rows are dropped. Rows are combined by customer and pane before
    they are shuffled; only combined rows are copied to dates.
    """
    window = Window(days_back, churn_period)
    rows = with_panes(hourly, "localStatshour", dates, window, day)
    utc = F.col("statshour").cast("timestamp")
    active = F.col("betAmountBaseCur") + F.col("ticketTurnoverBaseCur") > 0
    channel = F.col("channel")
    panes = rows.groupBy("idContacto", *PANE).agg(
        F.sum("casinoNGRbaseCur").alias("ngr_casino"),
        F.sum("sportsbookNGRbaseCur").alias("ngr_sports"),
        F.sum("depositAmountBaseCur").alias("deposit"),
        F.sum("withdrawAmountBaseCur").alias("withdraw"),
        F.sum("betAmountBaseCur").alias("bets"),
        F.sum("ticketTurnoverBaseCur").alias("turnover"),
        F.collect_set(F.when(active, utc)).alias("active"),
        F.collect_set(F.when(F.col(deposit_measure) > 0, utc)).alias("deposits"),
        F.collect_set(channel_bucket(channel)).alias("channels"),
        F.max(F.col("localStatshour").cast("timestamp")).alias("last"),
        F.sum(when_channel(channel, "EMAIL", F.col("promo_open"))).alias("opened"),
        F.sum(when_channel(channel, "SMS", F.col("promo_click"))).alias("sms"),
        F.sum(when_channel(channel, "EMAIL", F.col("promo_click"))).alias("clicked"),
    )
    statsdate = F.col("statsdate")

    def back(name: str) -> Column:
        return F.when(F.col("is_back"), F.col(name))

    def ahead(name: str) -> Column:
        return F.sum(F.when(~F.col("is_back"), F.col(name)))

    this_hour = F.exists("active", lambda hour: whole_units("HOUR", hour, statsdate) == 0)
    grouped = dates_of_panes(_by_customer(panes), dates, window).groupBy(*GROUP).agg(
        F.max(F.col("is_back")).alias("has_activity"),
        _non_null_sum(back("ngr_casino")).alias("ngr_casino"),
        _non_null_sum(back("ngr_sports")).alias("ngr_sports"),
        _non_null_sum(back("deposit")).alias("deposit"),
        _non_null_sum(back("withdraw")).alias("withdraw"),
        F.size(union_of(back("active"))).cast("long").alias("active_hours"),
        F.size(union_of(back("deposits"))).cast("long").alias("deposit_hours"),
        listed(union_of(back("channels"))).alias("channelList"),
        F.max(F.when(F.col("is_back") & this_hour, 1).otherwise(0)).alias("activeLastHour"),
        F.hour(F.max(back("last"))).alias("lastLocalHour"),
        F.sum(back("opened")).alias("promo_emails_opened"),
        F.sum(back("sms")).alias("promo_sms_clicked"),
        F.sum(back("clicked")).alias("promo_emails_clicked"),
        ahead("deposit").alias("pred_deposit_base_cur"),
        ahead("bets").alias("pred_casino_bet"),
        ahead("turnover").alias("pred_sports_bet"),
    )
    seen = grouped.filter("has_activity").drop("has_activity")
    return null_defaults(seen, ACTIVITY_DEFAULTS)


def _league_dates(league_events: DataFrame, dates: Dates, churn_period: int) -> DataFrame:
    """Leagues with the dates that an event of theirs follows within ``[date, date + churn_period]``."""
    window = Window(0, churn_period)
    panes = with_panes(league_events, "DEV_STARTDATE", dates, window).select(F.col("LEAGUENAME").alias("leagueName"), *PANE).distinct()
    return dates_of_panes(panes, dates, window).select("statsdate", "leagueName")


def upcoming_leagues(league_events: DataFrame, dates: Dates, churn_period: int) -> DataFrame:
    """Distinct leagues with an event starting in ``[date, date + churn_period]``."""
    return _league_dates(league_events, dates, churn_period).distinct()


def sports_totals(
    sports: DataFrame,
    league_events: DataFrame,
    dates: Dates,
    days_back: int,
    churn_period: int,
    day: str | None = None,
) -> DataFrame:
    """Sports turnover, value lists and the number of played leagues that return soon.

    Rows are combined by customer, league and pane: that shuffle spreads a dominant customer
    over its leagues and days. A league brings the dates it returns on, once, as an array.
    """
    window = Window(days_back, closed="right")
    playing = sports.filter(F.col("turnoverBaseCur") > 0).withColumnRenamed("statsdate", "played_at")
    panes = with_panes(playing, "played_at", dates, window, day).groupBy("idContacto", "leagueName", *PANE).agg(
        F.sum("turnoverBaseCur").alias("turnover"),
        F.collect_set(sport_bucket(F.col("sportName"))).alias("sports"),
        F.collect_set("isLive").alias("live"),
        F.collect_set("betType").alias("bets"),
    )
    returns = _league_dates(league_events, dates, churn_period).groupBy("leagueName").agg(F.collect_set("statsdate").alias("returns"))
    panes = panes.join(returns, "leagueName", "left")
    returning = F.when(F.array_contains("returns", F.col("statsdate")), F.col("leagueName"))
    totals = (
        dates_of_panes(_by_customer(panes), dates, window)
        .groupBy(*GROUP)
        .agg(
            F.sum("turnover").alias("sports_turnover"),
            listed(union_of("sports")).alias("sportsList"),
            listed(union_of("live")).alias("isLiveList"),
            listed(union_of("bets")).alias("betTypeList"),
            F.size(F.collect_set(returning)).cast("long").alias("futureLeaguesCnt"),
        )
    )
    return null_defaults(totals, SPORTS_DEFAULTS)


def customer_window_agg(
    sources: ChurnSources,
    dates: Dates,
    days_back: int = 7,
    churn_period: int = 7,
    as_reference: bool = False,
) -> DataFrame:
    """The churn table for all ``dates``.

    ``as_reference`` counts withdrawal hours as ``deposit_hours``, as the original
    warehouse query does.
    """
    measure = "withdrawAmountBaseCur" if as_reference else "depositAmountBaseCur"
    activity = hourly_activity(sources.hourly, dates, days_back, churn_period, measure, sources.day)
    casino = casino_totals(sources.casino, dates, days_back)
    sports = sports_totals(sources.sports, sources.league_events, dates, days_back, churn_period, sources.day)
    statsdate = F.col("statsdate")
    table = (
        activity.join(casino, GROUP, "left")
        .join(sports, GROUP, "left")
        .join(customer_features(sources.customers), "idContacto")
        .filter(is_eligible(statsdate))
        .withColumns(
            {
                "days_back": F.lit(days_back),
                "churn_period": F.lit(churn_period),
                "daysSinceReg": whole_units("DAY", F.col("regDate"), statsdate),
                "daysSinceFd": whole_units("DAY", F.col("firstDepositDate"), statsdate),
            }
        )
    )
    return null_defaults(table, {**CASINO_DEFAULTS, **SPORTS_DEFAULTS}).select(*OUTPUT_COLUMNS)


def write_churn_table(
    house: Warehouse,
    sources: ChurnSources,
    dates: Dates,
    days_back: int = 7,
    churn_period: int = 7,
    table: str = "customerWindowAgg",
) -> int:
    """Replace the ``(days_back, churn_period)`` slice of the stored table in one job.

    A rerun overwrites its own slice and leaves the others; a run without rows
    empties it. Returns the number of rows written.
    """
    result = customer_window_agg(sources, dates, days_back, churn_period)
    rows = counted_write(
        result, lambda df: house.replace_slices(df, table, ["days_back", "churn_period"])
    )
    if rows == 0:
        house.drop_slice(table, days_back=days_back, churn_period=churn_period)
    return rows

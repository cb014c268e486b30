"""Churn window queries on stand-ins built from the test tables.

The stand-ins read customers, nations and events; the same shapes are spelled out in
``SOURCES_SQL`` for the comparison.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.sources import new_warehouse
from suite.tables import Check, Tables, check, key_number, money
from tidemark.functions.clean import clean_category, map_codes, null_defaults, weekday_category
from tidemark.functions.clean import whole_units
from tidemark.functions.rules import channel_bucket, game_bucket, sport_bucket, when_channel
from tidemark.operators.joins import count_matches
from tidemark.operators.windows import (
    Window,
    backfill_range,
    PANE,
    dates_of_panes,
    distinct_count,
    distinct_list,
    last_date,
    rows_per_date,
    with_panes,
    sample_dates,
)
from tidemark.plans.churn import (
    ChurnSources,
    casino_totals,
    customer_features,
    customer_window_agg,
    hourly_activity,
    is_eligible,
    sports_totals,
    upcoming_leagues,
    write_churn_table,
)

DATES = ["2024-01-08", "2024-01-15", "2024-01-22"]
TWENTY_DATES = [f"2024-01-{day:02d}" for day in range(6, 26)]
DATE = "2024-01-15"

SPORTS = [
    "Football", "Soccer 1025083526", "Tennis", "Baseball", "Basketball", "Greyhounds",
    "Horse racing", "Ice Hockey", "Rugby", "Boxing", "Chess",
]
GAMES = ["Video Slot", "Ruleta Live", "Black Jack", "Poker"]
CHANNELS = {
    "click": "web_mobile", "view": "desktop", "purchase": "retail shop",
    "signup": "EMAIL", "error": "SMS",
}


def _pick(names, index):
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def local_events(t: Tables) -> DataFrame:
    """Events with the customer's local clock (0-4 hours ahead) and the key number."""
    shift = t.customer.select(
        F.col("c_custkey").alias("user_id"), (F.col("c_nationkey") % 5).alias("hours_ahead")
    )
    return (
        t.events.join(shift, "user_id")
        .withColumn("k", key_number())
        .withColumn(
            "local_ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.col("hours_ahead"))
        )
        .withColumn("amount", money("value"))
    )


def _total(event_type: str, measure: str = "amount"):
    return F.sum(F.when(F.col("event_type") == event_type, F.col(measure)))


def hourly(t: Tables) -> DataFrame:
    channels = [F.lit(x) for pair in CHANNELS.items() for x in pair]
    channel = F.create_map(*channels)[F.col("event_type")]
    zero = F.lit(0).cast("decimal(18,2)")
    return (
        local_events(t)
        .groupBy(
            F.col("user_id").alias("idContacto"),
            F.date_trunc("hour", "ts").alias("statshour"),
            F.date_trunc("hour", "local_ts").alias("localStatshour"),
        )
        .agg(
            F.min(channel).alias("channel"),
            _total("click").alias("casinoNGRbaseCur"),
            _total("view").alias("sportsbookNGRbaseCur"),
            _total("purchase").alias("depositAmountBaseCur"),
            _total("error").alias("withdrawAmountBaseCur"),
            F.coalesce(_total("click"), zero).alias("betAmountBaseCur"),
            F.sum(
                F.when(F.col("event_type") == "view", F.col("amount")).when(
                    F.col("event_type") != "purchase", zero
                )
            ).alias("ticketTurnoverBaseCur"),
            F.count(F.lit(1)).alias("promo_open"),
            F.sum(F.when(F.col("value") > 10, 1).otherwise(0)).alias("promo_click"),
        )
    )


def casino(t: Tables) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return (
        local_events(t)
        .filter(F.col("event_type").isin("click", "error"))
        .groupBy(
            F.col("user_id").alias("idContacto"),
            F.to_date("local_ts").alias("localDt"),
            _pick(GAMES, F.col("k") % 4).alias("gameCategory"),
        )
        .agg(
            F.coalesce(_total("click"), zero).alias("betAmountBaseCur"),
            F.coalesce(_total("error"), zero).alias("winAmountBaseCur"),
        )
    )


def sports(t: Tables) -> DataFrame:
    k = F.col("k")
    return (
        t.events.filter(F.col("event_type") == "view")
        .withColumn("k", key_number())
        .select(
            F.col("user_id").alias("idContacto"),
            F.col("ts").alias("statsdate"),
            _pick(SPORTS, k % 11).alias("sportName"),
            F.when(k % 2 == 0, "live").otherwise("prematch").alias("isLive"),
            F.concat(F.lit("type"), (k % 3).cast("string")).alias("betType"),
            F.concat(F.lit("league "), k.cast("string")).alias("leagueName"),
            money("value").alias("turnoverBaseCur"),
        )
    )


def league_events(t: Tables) -> DataFrame:
    return (
        t.events.filter(F.col("event_type") == "signup")
        .select(
            F.concat(F.lit("league "), key_number().cast("string")).alias("LEAGUENAME"),
            F.col("ts").alias("DEV_STARTDATE"),
        )
    )


def customers(t: Tables) -> DataFrame:
    firsts = t.events.groupBy("user_id").agg(
        F.min("ts").alias("regDate"),
        F.min_by("event_type", "ts").alias("regChannel"),
        F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("firstDepositDate"),
        F.sum(F.when(F.col("event_type") == "purchase", money("value"))).alias("tDepositAmt"),
    )
    key = F.col("c_custkey")
    gender = (
        F.when(key % 4 == 0, "Hombre").when(key % 4 == 1, "MUJER").when(key % 4 == 2, "señor x")
    )
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(firsts, key == F.col("user_id"), "left")
        .select(
            key.alias("idContacto"),
            "regDate", "firstDepositDate", "tDepositAmt", "regChannel",
            F.when(key % 50 == 0, "Yes").otherwise("No").alias("testAccount"),
            F.col("c_mktsegment").alias("partner"),
            gender.alias("gender"),
            F.col("n_name").alias("ResidentCountry"),
            F.concat_ws(" ", "c_mktsegment", "n_name").alias("mexosAdvertiser"),
        )
    )


def sources(t: Tables) -> ChurnSources:
    return ChurnSources(customers(t), casino(t), hourly(t), sports(t), league_events(t))


SOURCES_SQL = """
WITH ev AS (
  SELECT e.*, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CAST(value AS DECIMAL(18,2)) AS amount,
         ts + to_hours(CAST(c_nationkey % 5 AS INTEGER)) AS local_ts
  FROM events e JOIN customer ON c_custkey = user_id
),
hourly AS (
  SELECT user_id AS id, date_trunc('hour', ts) AS statshour,
         date_trunc('hour', local_ts) AS localhour,
         min(CASE event_type WHEN 'click' THEN 'web_mobile' WHEN 'view' THEN 'desktop'
             WHEN 'purchase' THEN 'retail shop' WHEN 'signup' THEN 'EMAIL'
             WHEN 'error' THEN 'SMS' END) AS channel,
         sum(CASE WHEN event_type = 'click' THEN amount END) AS casino_ngr,
         sum(CASE WHEN event_type = 'view' THEN amount END) AS sports_ngr,
         sum(CASE WHEN event_type = 'purchase' THEN amount END) AS deposit,
         sum(CASE WHEN event_type = 'error' THEN amount END) AS withdraw,
         coalesce(sum(CASE WHEN event_type = 'click' THEN amount END), 0) AS casino_bet,
         sum(CASE WHEN event_type = 'view' THEN amount
             WHEN event_type <> 'purchase' THEN CAST(0 AS DECIMAL(18,2)) END) AS sports_bet,
         count(*) AS promo_open,
         sum(CASE WHEN value > 10 THEN 1 ELSE 0 END) AS promo_click
  FROM ev GROUP BY 1, 2, 3
),
casino AS (
  SELECT user_id AS id, CAST(local_ts AS DATE) AS dt,
         CASE k % 4 WHEN 0 THEN 'Video Slot' WHEN 1 THEN 'Ruleta Live'
              WHEN 2 THEN 'Black Jack' ELSE 'Poker' END AS category,
         coalesce(sum(CASE WHEN event_type = 'click' THEN amount END), 0) AS bets,
         coalesce(sum(CASE WHEN event_type = 'error' THEN amount END), 0) AS wins
  FROM ev WHERE event_type IN ('click', 'error') GROUP BY 1, 2, 3
),
sports AS (
  SELECT user_id AS id, ts,
         ['Football', 'Soccer 1025083526', 'Tennis', 'Baseball', 'Basketball', 'Greyhounds',
          'Horse racing', 'Ice Hockey', 'Rugby', 'Boxing', 'Chess'][k % 11 + 1] AS sport_name,
         CASE WHEN k % 2 = 0 THEN 'live' ELSE 'prematch' END AS is_live,
         'type' || (k % 3) AS bet_type, 'league ' || k AS league, amount AS turnover
  FROM ev WHERE event_type = 'view'
),
leagues AS (
  SELECT 'league ' || CAST(json_extract(props, '$.k') AS INTEGER) AS league, ts
  FROM events WHERE event_type = 'signup'
),
customers AS (
  SELECT c_custkey AS id, f.*,
         CASE WHEN c_custkey % 50 = 0 THEN 'Yes' ELSE 'No' END AS test_account,
         c_mktsegment AS partner,
         CASE c_custkey % 4 WHEN 0 THEN 'Hombre' WHEN 1 THEN 'MUJER' WHEN 2 THEN 'señor x' END
           AS gender,
         n_name AS country, c_mktsegment || ' ' || n_name AS advertiser
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (
    SELECT user_id, min(ts) AS reg_date, arg_min(event_type, ts) AS reg_channel,
           min(CASE WHEN event_type = 'purchase' THEN ts END) AS first_deposit,
           sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END)
             AS total_deposit
    FROM events GROUP BY 1
  ) f ON f.user_id = c_custkey
)
"""


def _clean(column: str) -> str:
    return (
        f"replace(regexp_replace(coalesce({column}, 'missing'), '[^\\x00-\\x7F]+', '', 'g'),"
        " ' ', 'missing')"
    )


def _rules(subject: str, rules: list[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN {test.format(x=subject)} THEN '{name}'" for test, name in rules)
    return f"CASE {whens} ELSE '{default}' END"


GAME_TESTS = [
    ("{x} LIKE '%slot%'", "slots"),
    ("{x} LIKE '%ruleta%' OR {x} LIKE '%roulette%'", "roulette"),
    ("{x} LIKE '%blackjack%' OR {x} LIKE '%black jack%'", "blackjack"),
]
SPORT_TESTS = [
    ("({x} LIKE '%football%' OR {x} LIKE '%soccer%') AND {x} NOT LIKE '%1025083526%'", "football"),
    ("{x} LIKE '%tennis%'", "tennis"),
    ("{x} LIKE '%baseball%'", "baseball"),
    ("{x} LIKE '%basketball%'", "basketball"),
    ("{x} LIKE '%greyhound%'", "greyhounds"),
    ("{x} LIKE '%horse%'", "horses"),
    ("{x} LIKE '%hockey%'", "hockey"),
    ("{x} LIKE '%rugby%'", "rugby"),
    ("{x} LIKE '%1025083526%'", "american_football"),
    ("{x} LIKE '%box%'", "boxing"),
    ("{x} LIKE '%volleyball%'", "volleyball"),
]
CHANNEL_TESTS = [
    ("{x} LIKE '%mobile%'", "mobile"),
    ("{x} LIKE '%desktop%'", "desktop"),
    ("{x} LIKE '%retail%'", "retail"),
]
GAME_SQL = _rules("lower(category)", GAME_TESTS, "other")
SPORT_SQL = _rules("lower(sport_name)", SPORT_TESTS, "other")
CHANNEL_SQL = _rules("channel", CHANNEL_TESTS, "missing")


def _dates_sql(dates) -> str:
    values = ", ".join(f"(TIMESTAMP '{d} 00:00:00')" for d in dates)
    return f", dates AS (SELECT * FROM (VALUES {values}) v(d))"


def _window_ctes(back: int, churn: int) -> str:
    return f"""
, eligible AS (
  SELECT d, c.* FROM customers c JOIN dates ON reg_date < d AND first_deposit < d
  WHERE test_account = 'No' AND total_deposit > 0
    AND first_deposit > TIMESTAMP '1900-01-01' AND reg_date IS NOT NULL
),
hs AS (
  SELECT d, id, sum(coalesce(casino_ngr, 0)) AS ngr_casino,
         sum(coalesce(sports_ngr, 0)) AS ngr_sports, sum(coalesce(deposit, 0)) AS deposit,
         sum(coalesce(withdraw, 0)) AS withdraw,
         count(DISTINCT CASE WHEN casino_bet + sports_bet > 0 THEN statshour END) AS active_hours,
         count(DISTINCT CASE WHEN deposit > 0 THEN statshour END) AS deposit_hours,
         count(DISTINCT CASE WHEN withdraw > 0 THEN statshour END) AS withdraw_hours,
         max(CASE WHEN casino_bet + sports_bet > 0 AND date_sub('hour', statshour, d) = 0
             THEN 1 ELSE 0 END) AS active_last_hour,
         string_agg(DISTINCT {CHANNEL_SQL}, ',' ORDER BY {CHANNEL_SQL}) AS channels,
         hour(max(localhour)) AS last_local_hour,
         sum(CASE WHEN channel = 'EMAIL' THEN promo_open ELSE 0 END) AS emails_opened,
         sum(CASE WHEN channel = 'SMS' THEN promo_click ELSE 0 END) AS sms_clicked,
         sum(CASE WHEN channel = 'EMAIL' THEN promo_click ELSE 0 END) AS emails_clicked
  FROM hourly JOIN dates ON localhour >= d - INTERVAL {back} DAY AND localhour <= d
  GROUP BY 1, 2
),
cs AS (
  SELECT d, id, sum(bets) AS bets, sum(wins) AS wins, sum(bets) - sum(wins) AS gw,
         string_agg(DISTINCT {GAME_SQL}, ',' ORDER BY {GAME_SQL}) AS games
  FROM casino JOIN dates ON dt >= CAST(d AS DATE) - {back} AND dt <= CAST(d AS DATE)
  WHERE bets + wins > 0 GROUP BY 1, 2
),
plays AS (
  SELECT d, s.* FROM sports s JOIN dates ON ts > d - INTERVAL {back} DAY AND ts <= d
  WHERE turnover > 0
),
sp AS (
  SELECT d, id, sum(turnover) AS turnover,
         string_agg(DISTINCT {SPORT_SQL}, ',' ORDER BY {SPORT_SQL}) AS sports_list,
         string_agg(DISTINCT is_live, ',' ORDER BY is_live) AS live_list,
         string_agg(DISTINCT bet_type, ',' ORDER BY bet_type) AS bet_list
  FROM plays GROUP BY 1, 2
),
soon AS (
  SELECT DISTINCT d, league FROM leagues
  JOIN dates ON ts >= d AND ts <= d + INTERVAL {churn} DAY
),
fl AS (
  SELECT p.d, p.id, count(soon.league) AS future_leagues
  FROM (SELECT DISTINCT d, id, league FROM plays) p
  LEFT JOIN soon ON soon.d = p.d AND soon.league = p.league GROUP BY 1, 2
),
pred AS (
  SELECT d, id, sum(deposit) AS pred_deposit, sum(casino_bet) AS pred_casino,
         sum(sports_bet) AS pred_sports
  FROM hourly JOIN dates ON localhour > d AND localhour <= d + INTERVAL {churn} DAY
  GROUP BY 1, 2
)
"""


def flagship_sql(dates, back: int, churn: int) -> str:
    return (
        SOURCES_SQL
        + _dates_sql(dates)
        + _window_ctes(back, churn)
        + f"""
SELECT {back} AS days_back, {churn} AS churn_period,
  strftime(e.d, '%Y-%m-%d %H:%M:%S') AS statsdate, e.id AS idContacto,
  {_clean('partner')} AS partner,
  CASE WHEN lower({_clean('gender')}) = 'hombre' THEN 'M'
       WHEN lower({_clean('gender')}) = 'mujer' THEN 'F' ELSE {_clean('gender')} END AS gender,
  {_clean('country')} AS country, {_clean('reg_channel')} AS regChannel,
  {_clean('advertiser')} AS advertiser,
  'weekday_' || (dayofweek(reg_date) + 1) AS cat_regweekday,
  date_sub('day', reg_date, e.d) AS daysSinceReg,
  date_sub('day', first_deposit, e.d) AS daysSinceFd,
  channels AS channelList, coalesce(sports_list, 'missing') AS sportsList,
  active_hours, deposit_hours, CAST(deposit AS DOUBLE) AS deposit,
  CAST(ngr_sports AS DOUBLE) AS ngr_sports, CAST(ngr_casino AS DOUBLE) AS ngr_casino,
  coalesce(bet_list, 'missing') AS betTypeList, CAST(withdraw AS DOUBLE) AS withdraw,
  CAST(coalesce(wins, 0) AS DOUBLE) AS casino_wins,
  coalesce(games, 'missing') AS casino_game_list,
  CAST(coalesce(bets, 0) AS DOUBLE) AS casino_bets, CAST(coalesce(gw, 0) AS DOUBLE) AS casino_gw,
  coalesce(future_leagues, 0) AS futureLeaguesCnt,
  coalesce(live_list, 'missing') AS isLiveList,
  CAST(coalesce(turnover, 0) AS DOUBLE) AS sports_turnover,
  CAST(active_last_hour AS BIGINT) AS activeLastHour,
  CAST(last_local_hour AS BIGINT) AS lastLocalHour,
  CAST(pred_deposit AS DOUBLE) AS pred_deposit_base_cur,
  CAST(pred_casino AS DOUBLE) AS pred_casino_bet, CAST(pred_sports AS DOUBLE) AS pred_sports_bet,
  CAST(emails_opened AS BIGINT) AS promo_emails_opened,
  CAST(sms_clicked AS BIGINT) AS promo_sms_clicked,
  CAST(emails_clicked AS BIGINT) AS promo_emails_clicked
FROM eligible e JOIN hs ON hs.d = e.d AND hs.id = e.id
LEFT JOIN cs ON cs.d = e.d AND cs.id = e.id
LEFT JOIN sp ON sp.d = e.d AND sp.id = e.id
LEFT JOIN fl ON fl.d = e.d AND fl.id = e.id
LEFT JOIN pred ON pred.d = e.d AND pred.id = e.id
"""
    )


def flagship(t: Tables, dates=DATES, back: int = 7, churn: int = 7) -> DataFrame:
    return customer_window_agg(sources(t), dates, back, churn)


def flagship_stored(t: Tables) -> DataFrame:
    """Two slices stored, the first one twice; the second run replaces the first."""
    house = new_warehouse(t)
    write_churn_table(house, sources(t), DATES[:1], 7, 7, "churn")
    write_churn_table(house, sources(t), DATES, 1, 1, "churn")
    write_churn_table(house, sources(t), DATES[1:], 7, 7, "churn")
    return house.table("churn").groupBy("days_back", "churn_period", "statsdate").agg(
        F.count(F.lit(1)).alias("n"), F.sum("deposit").alias("deposit")
    )


def _stored_sql() -> str:
    parts = [
        f"""SELECT CAST(days_back AS BIGINT) AS days_back, CAST(churn_period AS BIGINT) AS churn_period,
        statsdate, count(*) AS n, round(sum(deposit), 2) AS deposit FROM ({query}) GROUP BY 1, 2, 3"""
        for query in (flagship_sql(DATES[1:], 7, 7), flagship_sql(DATES, 1, 1))
    ]
    return " UNION ALL ".join(parts)


def _sql(tail: str, dates=(DATE,), back: int = 7, churn: int = 7) -> str:
    return SOURCES_SQL + _dates_sql(dates) + _window_ctes(back, churn) + tail


def _day(d: str = "d") -> str:
    return f"strftime({d}, '%Y-%m-%d %H:%M:%S') AS statsdate"


# ---- scalar functions -----------------------------------------------------------


def eligible_customers(t: Tables) -> DataFrame:
    day = F.lit(DATE).cast("timestamp")
    return customers(t).filter(is_eligible(day)).select("idContacto", "partner", "testAccount")


def clean_categories(t: Tables) -> DataFrame:
    parts = t.part.select(
        F.lit("part").alias("origin"), F.col("p_partkey").alias("key"),
        clean_category(F.col("p_name")).alias("cleaned"),
    )
    texts = t.documents.select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("key"),
        F.md5(clean_category(F.col("text"))).alias("cleaned"),
    )
    people = customers(t).select(
        F.lit("gender").alias("origin"), F.col("idContacto").alias("key"),
        clean_category(F.col("gender")).alias("cleaned"),
    )
    return parts.unionByName(texts).unionByName(people)


def days_since(t: Tables) -> DataFrame:
    day = F.lit(DATE).cast("timestamp")
    return t.events.select(
        "event_id",
        whole_units("DAY", F.col("ts"), day).alias("days"),
        whole_units("HOUR", F.col("ts"), day).alias("hours"),
    )


def null_defaults_query(t: Tables) -> DataFrame:
    totals = t.events.groupBy("user_id").agg(
        F.sum(money("value")).alias("spent"),
        F.max("event_type").alias("last_type"),
        F.hour(F.max("ts")).alias("last_hour"),
    )
    joined = t.customer.join(totals, F.col("c_custkey") == F.col("user_id"), "left")
    return null_defaults(joined, {"spent": 0, "last_type": "missing", "last_hour": 25}).select(
        "c_custkey", "spent", "last_type", "last_hour"
    )


def promo_flags(t: Tables) -> DataFrame:
    rows = hourly(t)
    return rows.groupBy("idContacto").agg(
        F.sum(when_channel(F.col("channel"), "EMAIL", F.col("promo_open"))).alias("emails_opened"),
        F.sum(when_channel(F.col("channel"), "SMS", F.col("promo_click"))).alias("sms_clicked"),
        F.sum(when_channel(F.col("channel"), "EMAIL", F.col("promo_click"))).alias("emails_clicked"),
    )


# ---- windows --------------------------------------------------------------------


def multi_date_range(t: Tables) -> DataFrame:
    panes = with_panes(t.events, "ts", TWENTY_DATES, Window(7)).groupBy("user_id", *PANE)
    panes = panes.agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))
    dated = dates_of_panes(panes, TWENTY_DATES, Window(7)).groupBy("statsdate", "user_id")
    return dated.agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def daily_category_agg(t: Tables) -> DataFrame:
    rows = casino(t).filter(F.col("betAmountBaseCur") + F.col("winAmountBaseCur") > 0)
    return (
        rows_per_date(rows, "localDt", [DATE], Window(7))
        .groupBy("idContacto", "localDt", game_bucket(F.col("gameCategory")).alias("bucket"))
        .agg(F.sum("betAmountBaseCur").alias("bets"), F.sum("winAmountBaseCur").alias("wins"))
    )


def event_type_lists(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(distinct_list(F.col("event_type")).alias("event_types"))


def _activity(t: Tables) -> DataFrame:
    return hourly_activity(hourly(t), DATES, 7, 7)


def hourly_window_agg(t: Tables) -> DataFrame:
    return _activity(t).select(
        "statsdate", "idContacto", "ngr_casino", "ngr_sports", "deposit", "withdraw",
        "promo_emails_opened", "promo_sms_clicked", "promo_emails_clicked", "channelList",
    )


def active_hours(t: Tables) -> DataFrame:
    rows = rows_per_date(hourly(t), "localStatshour", [DATE], Window(7))
    active = F.col("betAmountBaseCur") + F.col("ticketTurnoverBaseCur") > 0
    return rows.groupBy("idContacto").agg(
        distinct_count(F.when(active, F.col("statshour"))).alias("active_hours"),
        distinct_count(F.when(F.col("depositAmountBaseCur") > 0, F.col("statshour"))).alias("deposit_hours"),
        distinct_count(F.when(F.col("withdrawAmountBaseCur") > 0, F.col("statshour"))).alias("withdraw_hours"),
    )


def label_window(t: Tables) -> DataFrame:
    return (
        rows_per_date(hourly(t), "localStatshour", DATES, Window(0, 7))
        .filter(F.col("localStatshour").cast("timestamp") > F.col("statsdate"))
        .groupBy("statsdate", "idContacto")
        .agg(
            F.sum("depositAmountBaseCur").alias("pred_deposit"),
            F.sum("betAmountBaseCur").alias("pred_casino"),
            F.sum("ticketTurnoverBaseCur").alias("pred_sports"),
        )
    )


def future_leagues(t: Tables) -> DataFrame:
    played = rows_per_date(
        sports(t).filter(F.col("turnoverBaseCur") > 0).withColumnRenamed("statsdate", "played_at"),
        "played_at", DATES, Window(7, closed="right"),
    )
    soon = upcoming_leagues(league_events(t), DATES, 7)
    return count_matches(played, soon, ["statsdate", "idContacto"], "leagueName", "future_leagues")


def feature_join(t: Tables) -> DataFrame:
    activity = _activity(t).select("statsdate", "idContacto", "deposit", "pred_deposit_base_cur")
    games = casino_totals(casino(t), DATES, 7).select("statsdate", "idContacto", "casino_gw")
    plays = sports_totals(sports(t), league_events(t), DATES, 7, 7).select(
        "statsdate", "idContacto", "sports_turnover"
    )
    keys = ["statsdate", "idContacto"]
    return (
        activity.join(games, keys, "left")
        .join(plays, keys, "left")
        .join(customer_features(customers(t)), "idContacto")
        .filter(is_eligible(F.col("statsdate")))
        .select(*keys, "partner", "deposit", "casino_gw", "sports_turnover", "pred_deposit_base_cur")
    )


AS_OF = datetime(2024, 2, 5)


def last_data_date(t: Tables) -> DataFrame:
    return last_date(t.events, "ts", "ts", AS_OF)


def sampled_dates(t: Tables) -> DataFrame:
    last = last_date(t.events, "ts", "ts", AS_OF).first()["last_date"]
    start, stop = backfill_range(last, stats_lookback=29, churn_period=7)
    return sample_dates(t.spark, start, stop, 10, seed=7)


CHECKS: dict[str, Check] = {
    "eligible_customers": check(
        eligible_customers,
        _sql("SELECT id AS idContacto, partner, test_account AS testAccount FROM eligible"),
    ),
    "clean_category": check(
        clean_categories,
        SOURCES_SQL
        + f"""SELECT 'part' AS origin, p_partkey AS key, {_clean('p_name')} AS cleaned FROM part
        UNION ALL SELECT 'document', doc_id, md5({_clean('text')}) FROM documents
        UNION ALL SELECT 'gender', id, {_clean('gender')} FROM customers""",
    ),
    "weekday_category": check(
        lambda t: t.orders.select(
            "o_orderkey", weekday_category(F.col("o_orderdate")).alias("weekday")
        ),
        "SELECT o_orderkey, 'weekday_' || (dayofweek(o_orderdate) + 1) AS weekday FROM orders",
    ),
    "days_since": check(
        days_since,
        f"""SELECT event_id, date_sub('day', ts, TIMESTAMP '{DATE}') AS days,
        date_sub('hour', ts, TIMESTAMP '{DATE}') AS hours FROM events""",
    ),
    "bucket_game": check(
        lambda t: casino(t).groupBy(game_bucket(F.col("gameCategory")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        SOURCES_SQL + f"SELECT {GAME_SQL} AS bucket, count(*) AS n FROM casino GROUP BY 1",
    ),
    "bucket_sport": check(
        lambda t: sports(t).groupBy(sport_bucket(F.col("sportName")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        SOURCES_SQL + f"SELECT {SPORT_SQL} AS bucket, count(*) AS n FROM sports GROUP BY 1",
    ),
    "bucket_channel": check(
        lambda t: hourly(t).groupBy(channel_bucket(F.col("channel")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        SOURCES_SQL + f"SELECT {CHANNEL_SQL} AS bucket, count(*) AS n FROM hourly GROUP BY 1",
    ),
    "promo_flags": check(
        promo_flags,
        SOURCES_SQL
        + """SELECT id AS idContacto,
        CAST(sum(CASE WHEN channel = 'EMAIL' THEN promo_open ELSE 0 END) AS BIGINT) AS emails_opened,
        CAST(sum(CASE WHEN channel = 'SMS' THEN promo_click ELSE 0 END) AS BIGINT) AS sms_clicked,
        CAST(sum(CASE WHEN channel = 'EMAIL' THEN promo_click ELSE 0 END) AS BIGINT) AS emails_clicked
        FROM hourly GROUP BY 1""",
    ),
    "gender_map": check(
        lambda t: customers(t).select("idContacto", map_codes(F.col("gender")).alias("gender")),
        SOURCES_SQL
        + """SELECT id AS idContacto, CASE WHEN lower(gender) = 'hombre' THEN 'M'
        WHEN lower(gender) = 'mujer' THEN 'F' ELSE gender END AS gender FROM customers""",
    ),
    "null_defaults": check(
        null_defaults_query,
        """SELECT c_custkey, CAST(coalesce(spent, 0) AS DOUBLE) AS spent,
        coalesce(last_type, 'missing') AS last_type,
        CAST(coalesce(last_hour, 25) AS BIGINT) AS last_hour
        FROM customer LEFT JOIN (
          SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS spent,
                 max(event_type) AS last_type, hour(max(ts)) AS last_hour
          FROM events GROUP BY 1) ON user_id = c_custkey""",
    ),
    "multi_date_range": check(
        multi_date_range,
        f"""SELECT {_day()}, user_id, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM events JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-06',
          TIMESTAMP '2024-01-25', INTERVAL 1 DAY)) AS d) ON ts >= d - INTERVAL 7 DAY AND ts <= d
        GROUP BY d, user_id""",
    ),
    "daily_category_agg": check(
        daily_category_agg,
        _sql(
            f"""SELECT id AS idContacto, strftime(dt, '%Y-%m-%d') AS localDt, {GAME_SQL} AS bucket,
            CAST(sum(bets) AS DOUBLE) AS bets, CAST(sum(wins) AS DOUBLE) AS wins
            FROM casino JOIN dates ON dt >= CAST(d AS DATE) - 7 AND dt <= CAST(d AS DATE)
            WHERE bets + wins > 0 GROUP BY 1, 2, 3"""
        ),
    ),
    "customer_totals": check(
        lambda t: casino_totals(casino(t), DATES, 7),
        _sql(
            f"""SELECT {_day()}, id AS idContacto, CAST(bets AS DOUBLE) AS casino_bets,
            CAST(wins AS DOUBLE) AS casino_wins, CAST(gw AS DOUBLE) AS casino_gw,
            games AS casino_game_list FROM cs""",
            DATES,
        ),
    ),
    "distinct_list_agg": check(
        event_type_lists,
        """SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
        FROM events GROUP BY 1""",
    ),
    "hourly_window_agg": check(
        hourly_window_agg,
        _sql(
            f"""SELECT {_day()}, id AS idContacto, CAST(ngr_casino AS DOUBLE) AS ngr_casino,
            CAST(ngr_sports AS DOUBLE) AS ngr_sports, CAST(deposit AS DOUBLE) AS deposit,
            CAST(withdraw AS DOUBLE) AS withdraw,
            CAST(emails_opened AS BIGINT) AS promo_emails_opened,
            CAST(sms_clicked AS BIGINT) AS promo_sms_clicked,
            CAST(emails_clicked AS BIGINT) AS promo_emails_clicked, channels AS channelList
            FROM hs""",
            DATES,
        ),
    ),
    "active_hours": check(
        active_hours,
        _sql("SELECT id AS idContacto, active_hours, deposit_hours, withdraw_hours FROM hs"),
    ),
    "active_last_hour": check(
        lambda t: _activity(t).select("statsdate", "idContacto", "activeLastHour"),
        _sql(
            f"""SELECT {_day()}, id AS idContacto,
            CAST(active_last_hour AS BIGINT) AS activeLastHour FROM hs""",
            DATES,
        ),
    ),
    "last_local_hour": check(
        lambda t: _activity(t).select("statsdate", "idContacto", "lastLocalHour"),
        _sql(
            f"""SELECT {_day()}, id AS idContacto,
            CAST(last_local_hour AS BIGINT) AS lastLocalHour FROM hs""",
            DATES,
        ),
    ),
    "sports_agg": check(
        lambda t: sports_totals(sports(t), league_events(t), DATES, 7, 7),
        _sql(
            f"""SELECT {_day('sp.d')}, sp.id AS idContacto,
            CAST(turnover AS DOUBLE) AS sports_turnover, sports_list AS sportsList,
            live_list AS isLiveList, bet_list AS betTypeList,
            future_leagues AS futureLeaguesCnt
            FROM sp JOIN fl ON fl.d = sp.d AND fl.id = sp.id""",
            DATES,
        ),
    ),
    "label_window": check(
        label_window,
        _sql(
            f"""SELECT {_day()}, id AS idContacto, CAST(pred_deposit AS DOUBLE) AS pred_deposit,
            CAST(pred_casino AS DOUBLE) AS pred_casino,
            CAST(pred_sports AS DOUBLE) AS pred_sports FROM pred""",
            DATES,
        ),
    ),
    "future_leagues": check(
        future_leagues,
        _sql(f"SELECT {_day()}, id AS idContacto, future_leagues FROM fl", DATES),
    ),
    "feature_join": check(
        feature_join,
        _sql(
            f"""SELECT {_day('e.d')}, e.id AS idContacto, {_clean('partner')} AS partner,
            CAST(deposit AS DOUBLE) AS deposit, CAST(gw AS DOUBLE) AS casino_gw,
            CAST(turnover AS DOUBLE) AS sports_turnover,
            CAST(pred_deposit AS DOUBLE) AS pred_deposit_base_cur
            FROM eligible e JOIN hs ON hs.d = e.d AND hs.id = e.id
            LEFT JOIN cs ON cs.d = e.d AND cs.id = e.id
            LEFT JOIN sp ON sp.d = e.d AND sp.id = e.id
            LEFT JOIN pred ON pred.d = e.d AND pred.id = e.id""",
            DATES,
        ),
    ),
    "last_data_date": check(
        last_data_date,
        """SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_date FROM events
        WHERE ts >= TIMESTAMP '2024-02-05' - INTERVAL 14 DAY""",
    ),
    "sample_dates": check(
        lambda t: sampled_dates(t).agg(
            F.count_distinct("statsdate").alias("n"), (F.max("statsdate") <= F.lit(AS_OF).cast("timestamp")).alias("before_end"),
        ),
        "SELECT CAST(10 AS BIGINT) AS n, TRUE AS before_end FROM (SELECT max(ts) AS last FROM events) WHERE last IS NOT NULL",
    ),
    "customer_window_agg": check(flagship, flagship_sql(DATES, 7, 7)),
    "customer_window_table": check(flagship_stored, _stored_sql()),
    "customer_window_agg_1_1": check(
        lambda t: flagship(t, TWENTY_DATES, 1, 1), flagship_sql(TWENTY_DATES, 1, 1)
    ),
}

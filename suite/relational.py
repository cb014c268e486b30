"""Joins, upserts, incremental windows, SQL templates, model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.sources import new_warehouse
from suite.tables import Check, Tables, check, key_number, money
from tidemark.functions.clean import assemble_defaults
from tidemark.functions.humanize import kpi_humanize
from tidemark.operators.joins import join_on_keys, seen_values_only
from tidemark.operators.upsert import write_predictions
from tidemark.plans.incremental import date_windows, incremental_rows
from tidemark.plans.templates import joined_templates


def multi_query_join(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_suppkey")
    return join_on_keys(
        [
            lines.agg(F.count(F.lit(1)).alias("n")),
            lines.agg(F.sum(money("l_extendedprice")).alias("price")),
            t.lineitem.filter(F.col("l_returnflag") == "R").groupBy("l_suppkey").agg(
                F.count(F.lit(1)).alias("returned")
            ),
        ],
        ["l_suppkey"],
    )


def seen_ids(t: Tables) -> DataFrame:
    """Late events whose user and key number both occur among the early ones."""
    rows = t.events.withColumn("k", key_number())
    early = F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")
    kept = seen_values_only(rows.filter(~early), rows.filter(early), ["user_id", "k"])
    return kept.select("event_id", "user_id", "k")


def _predictions(t: Tables, condition, score, run: int) -> DataFrame:
    return t.customer.filter(condition).select(
        F.lit(run).cast("long").alias("ts"),
        score.alias("model_value"),
        F.concat(F.lit("nation "), (F.col("c_nationkey") % 3).cast("string")).alias("submodel_name"),
        F.col("c_custkey").alias("id"),
    )


def merge_predictions(t: Tables) -> DataFrame:
    house = new_warehouse(t)
    balance = F.col("c_acctbal")
    write_predictions(house, _predictions(t, balance > 2000, balance, 1), "predictions")
    second = _predictions(t, (balance < 5000) & (F.col("c_nationkey") % 3 < 2), balance * 2, 2)
    return write_predictions(house, second, "predictions")


def truncate_predictions(t: Tables) -> DataFrame:
    house = new_warehouse(t)
    balance = F.col("c_acctbal")
    write_predictions(house, _predictions(t, balance > 2000, balance, 1), "predictions")
    second = _predictions(t, balance < 5000, balance * 2, 2)
    return write_predictions(house, second, "predictions", method="truncate")


def incremental_windows(t: Tables) -> DataFrame:
    tables = {
        "orders": (t.orders, "o_orderdate"),
        "events": (t.events, "ts"),
        "lineitem": (t.lineitem, "l_shipdate"),
    }
    ends = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.date_sub(F.to_date(F.max(column)), 5).alias("date_from"),
            F.to_date(F.max(column)).alias("date_to"),
        )
        for name, (df, column) in tables.items()
    ]
    windows = date_windows(ends[0].unionByName(ends[1]).unionByName(ends[2]), days_offset=3)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        for name, df in incremental_rows(tables, windows).items()
    ]
    return windows.join(counts[0].unionByName(counts[1]).unionByName(counts[2]), "table_name")


TEMPLATES = {
    "orders": """SELECT o_custkey AS customer, count(*) AS orders FROM IDENTIFIER(:orders)
        WHERE o_orderdate >= CAST(:since AS DATE) GROUP BY o_custkey""",
    "priorities": """SELECT o_custkey AS customer, count(DISTINCT o_orderpriority) AS priorities
        FROM IDENTIFIER(:orders) WHERE o_totalprice > :price GROUP BY o_custkey""",
    "balance": """SELECT c_custkey AS customer, c_acctbal AS balance FROM IDENTIFIER(:customers)
        WHERE c_mktsegment = :segment""",
}


def sql_templates(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("template_orders")
    t.customer.createOrReplaceTempView("template_customers")
    parameters = {
        "orders": "template_orders", "customers": "template_customers",
        "since": "1998-01-01", "price": 100000.0, "segment": "HOUSEHOLD",
    }
    return joined_templates(t.spark, TEMPLATES, parameters, ["customer"])


def assembled(t: Tables) -> DataFrame:
    structure = {"c_acctbal": 0.0, "segment": "none", "visits": 3, "channel": "web"}
    rows = t.customer.withColumn("segment", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")))
    return assemble_defaults(rows, structure, static={"channel": "app"}, keep=["c_custkey"])


def humanized(t: Tables) -> DataFrame:
    revenue = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum(money("o_totalprice")).alias("revenue"))
    )
    scales = F.explode(F.array(*[F.lit(x) for x in (0.0, 1e-6, -1e-3, 1.0, 1e3, 1e6, 1e9)]))
    scaled = revenue.select("c_nationkey", "revenue", scales.alias("scale")).withColumn(
        "amount", F.col("revenue").cast("double") * F.col("scale")
    )
    return scaled.select(
        "c_nationkey", "scale",
        *[kpi_humanize(F.col("amount"), p).alias(f"text_{p}") for p in (0, 1, 2, 5)],
    )


def _human_sql(digits: int) -> str:
    return f"""printf('%.{digits}f', amount / pow(1000.0, unit))
        || ['', ' Thousand', ' Million', ' Billion', ' Trillion'][unit + 1]"""


CHECKS: dict[str, Check] = {
    "multi_query_join": check(
        multi_query_join,
        """SELECT l_suppkey, count(*) AS n,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
        count(*) FILTER (l_returnflag = 'R') AS returned
        FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') > 0""",
    ),
    "seen_ids_only": check(
        seen_ids,
        """WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
        early AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-02')
        SELECT event_id, user_id, k FROM e WHERE ts >= TIMESTAMP '2024-01-02'
        AND user_id IN (SELECT user_id FROM early) AND k IN (SELECT k FROM early)""",
    ),
    "merge_predictions": check(
        merge_predictions,
        """WITH rows AS (SELECT *, 'nation ' || (c_nationkey % 3) AS s,
          c_acctbal < 5000 AND c_nationkey % 3 < 2 AS again FROM customer)
        SELECT CASE WHEN again THEN 2 ELSE 1 END AS ts,
        CASE WHEN again THEN c_acctbal * 2 ELSE c_acctbal END AS model_value,
        s AS submodel_name, c_custkey AS id FROM rows WHERE c_acctbal > 2000 OR again""",
    ),
    "write_predictions": check(
        truncate_predictions,
        """SELECT 2 AS ts, c_acctbal * 2 AS model_value,
        'nation ' || (c_nationkey % 3) AS submodel_name, c_custkey AS id
        FROM customer WHERE c_acctbal < 5000""",
    ),
    "incremental_windows": check(
        incremental_windows,
        " UNION ALL ".join(
            f"""SELECT '{table}' AS table_name, strftime(d - 8, '%Y-%m-%d') AS date_from,
            strftime(d, '%Y-%m-%d') AS date_to,
            (SELECT count(*) FROM {table} WHERE CAST({column} AS DATE) BETWEEN d - 8 AND d) AS n
            FROM (SELECT CAST(max({column}) AS DATE) AS d FROM {table})"""
            for table, column in (
                ("orders", "o_orderdate"), ("events", "ts"), ("lineitem", "l_shipdate")
            )
        ),
    ),
    "sql_templates": check(
        sql_templates,
        """SELECT c_custkey AS customer, orders, priorities, c_acctbal AS balance
        FROM customer
        JOIN (SELECT o_custkey, count(*) AS orders FROM orders
              WHERE o_orderdate >= DATE '1998-01-01' GROUP BY 1) a ON a.o_custkey = c_custkey
        JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities FROM orders
              WHERE o_totalprice > 100000 GROUP BY 1) b ON b.o_custkey = c_custkey
        WHERE c_mktsegment = 'HOUSEHOLD'""",
    ),
    "assemble_defaults": check(
        assembled,
        """SELECT c_custkey, c_acctbal,
        CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment,
        CAST(3 AS BIGINT) AS visits, 'app' AS channel FROM customer""",
    ),
    "kpi_humanize": check(
        humanized,
        f"""WITH r AS (
          SELECT c_nationkey, scale,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) * scale AS amount
          FROM orders JOIN customer ON o_custkey = c_custkey,
            (VALUES (0.0::DOUBLE), (1e-6), (-1e-3), (1.0), (1e3), (1e6), (1e9)) v(scale)
          GROUP BY 1, 2),
        u AS (SELECT *, CASE WHEN amount = 0 THEN 0 ELSE CAST(least(4, greatest(0,
            floor(log10(abs(amount)) / 3))) AS INTEGER) END AS unit FROM r)
        SELECT c_nationkey, scale, {_human_sql(0)} AS text_0, {_human_sql(1)} AS text_1,
          {_human_sql(2)} AS text_2, {_human_sql(0)} AS text_5 FROM u""",
    ),
}

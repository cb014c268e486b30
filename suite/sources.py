"""Source and sink queries: write the test tables out, read them back."""

from __future__ import annotations

import json
import uuid
from datetime import date
from functools import partial
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.tables import Check, Tables, check, money
from tidemark.operators.position import chunk_rows, kfold
from tidemark.session import new_location, written
from tidemark.sources.export import export_files, query_to_csv
from tidemark.sources.files import csv_to_ndjson, read_delimited, read_ndjson, read_text_files
from tidemark.sources.load import load_files
from tidemark.sources.messages import delivery_totals, send_batches
from tidemark.sources.rows import rows_to_json, rows_to_vector
from tidemark.sources.schema import PREDICTION_SCHEMAS, schema_from_json
from tidemark.sources.warehouse import WRITE_APPEND, Warehouse, date_ends


def new_warehouse(t: Tables) -> Warehouse:
    return Warehouse(t.spark, f"tm_{uuid.uuid4().hex}", new_location(t.spark, "warehouse"))


ORDERS_SCHEMA = schema_from_json(
    [
        {"name": "o_orderkey", "type": "INTEGER"},
        {"name": "o_custkey", "type": "INTEGER"},
        {"name": "o_orderstatus", "type": "STRING"},
        {"name": "o_totalprice", "type": "FLOAT"},
        {"name": "o_orderdate", "type": "DATETIME"},
        {"name": "o_orderpriority", "type": "STRING"},
    ]
)
EVENTS_SCHEMA = schema_from_json(
    [
        {"name": "event_id", "type": "INTEGER"},
        {"name": "ts", "type": "TIMESTAMP"},
        {"name": "user_id", "type": "INTEGER"},
        {"name": "event_type", "type": "STRING"},
        {"name": "value", "type": "FLOAT"},
        {"name": "props", "type": "STRING"},
    ]
)


def csv_round_trip(t: Tables) -> DataFrame:
    path = new_location(t.spark, "orders-csv")
    t.orders.write.csv(path, header=True, sep=";")
    return load_files(
        new_warehouse(t), "orders", path, "CSV", ORDERS_SCHEMA, delimiter=";", skip_leading_rows=1
    )


def ndjson_round_trip(t: Tables) -> DataFrame:
    path = new_location(t.spark, "events-json")
    t.events.write.json(path)
    return read_ndjson(t.spark, path, EVENTS_SCHEMA)


def nested_schema(t: Tables) -> DataFrame:
    """Customers as prediction records in JSON, read by the declared nested schema."""
    path = new_location(t.spark, "records")
    value = F.array(
        F.struct(F.lit(0).alias("class"), (F.col("c_acctbal") / 4).alias("value")),
        F.struct(F.lit(1).alias("class"), F.col("c_acctbal").alias("value")),
    )
    t.customer.select(F.col("c_custkey").alias("id"), value.alias("model_value")).write.json(path)
    records = read_ndjson(t.spark, path, PREDICTION_SCHEMAS["classification"])
    return records.select("id", F.inline("model_value").alias("value", "class"), "model_name")


def query_to_table(t: Tables) -> DataFrame:
    house = new_warehouse(t)
    result = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    schema = T.StructType().add("o_orderstatus", "string").add("n", "double")
    house.write(result, "by_status", write=WRITE_APPEND, schema=schema)
    return house.write(result, "by_status", write=WRITE_APPEND, schema=schema)


def partitioned_table(t: Tables) -> DataFrame:
    stored = new_warehouse(t).write_by_day(t.events, "events", "ts")
    return (
        stored.filter(F.col("day").between("2024-01-05", "2024-01-09"))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))
    )


def partition_retention(t: Tables) -> DataFrame:
    house = new_warehouse(t)
    house.write_by_day(t.events, "events", "ts")
    house.expire_days("events", 7, as_of=date(2024, 1, 30))
    return house.table("events").groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def export_round_trip(t: Tables) -> DataFrame:
    totals = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("long").alias("quantity"), F.count(F.lit(1)).alias("n")
    )
    path = new_location(t.spark, "export")
    export_files(totals, path, "CSV", "GZIP", split_files=False)
    schema = T.StructType().add("l_returnflag", "string").add("l_linestatus", "string")
    return read_delimited(
        t.spark, path, schema.add("quantity", "long").add("n", "long"), skip_leading_rows=1
    )


def query_to_csv_count(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    path = new_location(t.spark, "priorities")
    rows = query_to_csv(totals, path)
    schema = T.StructType().add("o_orderpriority", "string").add("n", "long")
    return read_delimited(t.spark, path, schema, skip_leading_rows=1).withColumn(
        "rows_written", F.lit(rows)
    )


def copy_table(t: Tables) -> DataFrame:
    house = new_warehouse(t)
    house.write(t.nation, "nation")
    rows = house.copy("nation", "nation_copy")
    return house.table("nation_copy").withColumn("rows_copied", F.lit(rows))


def delete_rows(t: Tables) -> DataFrame:
    house = new_warehouse(t)
    house.write(t.region, "region")
    house.delete_rows("region")
    emptied = house.table("region")
    return emptied.agg(
        F.count(F.lit(1)).alias("rows_left"), F.lit(",".join(emptied.columns)).alias("columns")
    )


def replace_slice(t: Tables) -> DataFrame:
    """Two slices written, one of them rewritten with other rows."""
    house = new_warehouse(t)

    def part(rows: DataFrame, back: int) -> DataFrame:
        return rows.select(
            "event_id", "event_type", F.lit(back).alias("days_back"), F.lit(7).alias("churn_period")
        )

    keys = ["days_back", "churn_period"]
    house.replace_slices(part(t.events, 7), "slices", keys)
    house.replace_slices(part(t.events, 1), "slices", keys)
    clicks = t.events.filter(F.col("event_type") == "click")
    house.replace_slices(part(clicks, 7), "slices", keys)
    return house.table("slices").groupBy("days_back", "event_type").agg(F.count(F.lit(1)).alias("n"))


def sharded_ends(t: Tables) -> DataFrame:
    """Events as daily shards, made by one partitioned write per shard name."""
    house = new_warehouse(t)
    root = house.location()
    t.events.withColumn("shard", F.date_format("ts", "yyyyMMdd")).write.partitionBy("shard").parquet(
        f"{root}/all"
    )
    days = [r["shard"] for r in t.spark.read.parquet(f"{root}/all").select("shard").distinct().toLocalIterator()]
    for day in days:
        t.spark.read.parquet(f"{root}/all/shard={day}").write.parquet(f"{root}/events_{day}")
    return house.shard_ends("events_")


def csv_to_json_text(t: Tables) -> DataFrame:
    source, target = new_location(t.spark, "supplier-csv"), new_location(t.spark, "supplier-json")
    t.supplier.write.csv(source, header=True)
    csv_to_ndjson(t.spark, source, target)
    kinds = t.spark.read.json(target)
    return kinds.select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal",
        F.typeof("s_acctbal").alias("stored_as"),
    )


def nation_json(t: Tables) -> DataFrame:
    rows = rows_to_json(t.nation, "line")
    return rows.select(
        F.get_json_object("line", "$.n_nationkey").cast("long").alias("n_nationkey"),
        F.get_json_object("line", "$.n_name").alias("n_name"),
        F.get_json_object("line", "$.n_regionkey").cast("long").alias("n_regionkey"),
    )


def region_vector(t: Tables) -> DataFrame:
    ends = t.nation.groupBy("n_regionkey").agg(
        F.min("n_nationkey").alias("low"), F.max("n_nationkey").alias("high")
    )
    return rows_to_vector(ends.select("n_regionkey", "low", "high"), position="place")


def open_checking_sender():
    """Rejects customers whose key ends in 7."""
    return lambda entries: [
        e["Id"] for e in entries if json.loads(e["MessageBody"])["c_custkey"] % 10 == 7
    ]


def message_batches(t: Tables) -> DataFrame:
    return delivery_totals(send_batches(t.customer, open_checking_sender))


#: Ids of several texts that are sent to all tasks; with more of them all texts meet by id.
FEW_IDS = 1 << 16


def write_texts(texts: DataFrame, path: str) -> int:
    """One file per ``doc_id``, its texts as lines, written by the tasks; the number of files.

    Spark's own writer makes a folder per file, each of which its reader then lists by itself.
    A file is moved to its name when it is whole, so a task that runs twice leaves it whole.
    """

    def write(kind, batches):
        files, root = FileSystem.from_uri(path)
        task = TaskContext.get()
        folder, mark = f"{root}/batch={kind}-{task.partitionId()}", task.taskAttemptId()
        files.create_dir(folder)
        rows = (row for b in batches for row in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True))
        made = 0
        for key, lines in groupby(rows, itemgetter(0)):
            with files.open_output_stream(f"{folder}/_{mark}") as out:
                for _, text in lines:
                    out.write((text or "").encode() + b"\n")
            files.move(f"{folder}/_{mark}", f"{folder}/doc_id={key}.txt")
            made += 1
        yield pa.RecordBatch.from_pydict({"files": [made]})

    files, root = FileSystem.from_uri(path)
    files.create_dir(root)  # there even without texts
    texts = texts.select("doc_id", "text")
    # only texts whose ids come again must meet; the others are written where they are read
    again = written(texts.groupBy(F.col("doc_id").alias("again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("again"), "ids")
    once, met = texts.limit(0), texts
    if again.count() <= FEW_IDS:
        same = F.col("doc_id").eqNullSafe(F.col("again"))
        once, met = (texts.join(F.broadcast(again), same, kind) for kind in ("left_anti", "left_semi"))
    met = met.repartition("doc_id").sortWithinPartitions("doc_id")
    return sum(part.mapInArrow(partial(write, kind), "files long").agg(F.sum("files")).first()[0] or 0 for kind, part in (("once", once), ("met", met)))


def text_files(t: Tables) -> DataFrame:
    """One file per document, whole text, read back as rows."""
    path = new_location(t.spark, "texts")
    write_texts(t.documents.select("doc_id", F.translate("text", "\r", "").alias("text")), path)
    return read_text_files(t.spark, path).select(
        F.regexp_extract("path", "doc_id=([0-9]+)", 1).cast("long").alias("doc_id"),
        F.md5(F.regexp_replace("text", r"\n+\z", "")).alias("text_md5"),
    )


CHECKS: dict[str, Check] = {
    "read_csv_table": check(
        csv_round_trip,
        """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders""",
    ),
    "read_ndjson_table": check(
        ndjson_round_trip,
        """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type,
        value, props FROM events""",
    ),
    "schema_from_json": check(
        nested_schema,
        """SELECT c_custkey AS id, CAST(class AS BIGINT) AS class,
        CASE class WHEN 0 THEN c_acctbal / 4 ELSE c_acctbal END AS value,
        CAST(NULL AS VARCHAR) AS model_name
        FROM customer, (VALUES (0), (1)) v(class)""",
    ),
    "query_to_table": check(
        query_to_table,
        """SELECT o_orderstatus, CAST(count(*) AS DOUBLE) AS n
        FROM orders, (VALUES (1), (2)) v(run) GROUP BY o_orderstatus, run""",
    ),
    "partitioned_table": check(
        partitioned_table,
        """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY 1""",
    ),
    "partition_retention": check(
        partition_retention,
        """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
        WHERE CAST(ts AS DATE) >= DATE '2024-01-23' GROUP BY 1""",
    ),
    "export_files": check(
        export_round_trip,
        """SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity,
        count(*) AS n FROM lineitem GROUP BY 1, 2""",
    ),
    "query_to_csv": check(
        query_to_csv_count,
        """SELECT o_orderpriority, count(*) AS n, count(*) OVER () AS rows_written
        FROM orders GROUP BY 1""",
    ),
    "copy_table": check(
        copy_table, "SELECT *, count(*) OVER () AS rows_copied FROM nation"
    ),
    "delete_rows": check(
        delete_rows,
        """SELECT count(*) FILTER (false) AS rows_left, 'r_regionkey,r_name' AS columns
        FROM region""",
    ),
    "replace_slice": check(
        replace_slice,
        """SELECT CAST(days_back AS BIGINT) AS days_back, event_type, count(*) AS n
        FROM events, (VALUES (1), (7)) v(days_back)
        WHERE days_back = 1 OR event_type = 'click' GROUP BY 1, 2""",
    ),
    "table_date_ends": check(
        lambda t: date_ends(t.lineitem, "l_shipdate"),
        """SELECT strftime(min(l_shipdate), '%Y-%m-%d') AS min_date,
        strftime(max(l_shipdate), '%Y-%m-%d') AS max_date FROM lineitem""",
    ),
    "sharded_table_ends": check(
        sharded_ends,
        """SELECT strftime(min(ts), '%Y-%m-%d') AS min_date,
        strftime(max(ts), '%Y-%m-%d') AS max_date FROM events""",
    ),
    "csv_to_ndjson": check(
        csv_to_json_text,
        """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
        CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal,
        'string' AS stored_as FROM supplier""",
    ),
    "rows_to_json": check(
        nation_json,
        """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
        CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation""",
    ),
    "rows_to_vector": check(
        region_vector,
        """SELECT CAST(place AS BIGINT) AS place, CAST(CASE place WHEN 0 THEN n_regionkey WHEN 1 THEN low
        ELSE high END AS BIGINT) AS value
        FROM (SELECT n_regionkey, min(n_nationkey) AS low, max(n_nationkey) AS high
              FROM nation GROUP BY 1), (VALUES (0), (1), (2)) v(place)""",
    ),
    "message_batches": check(
        message_batches,
        """SELECT count(*) AS sent, count(*) FILTER (c_custkey % 10 <> 7) AS received,
        count(*) FILTER (c_custkey % 10 = 7) AS failed FROM customer""",
    ),
    "read_text_files": check(
        text_files,
        """SELECT doc_id, md5(regexp_replace(replace(text, chr(13), ''), '\\n+$', ''))
        AS text_md5 FROM documents""",
    ),
    "chunk_rows": check(
        lambda t: chunk_rows(t.orders.select("o_orderkey"), ["o_orderkey"], chunks=7)
        .groupBy("chunk")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        ),
        """SELECT CAST(floor(p / (total // 7 + 1)) AS BIGINT) AS chunk, count(*) AS n,
        min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p,
              count(*) OVER () AS total FROM orders) GROUP BY 1""",
    ),
    "kfold": check(
        lambda t: kfold(t.orders.select("o_orderkey"), ["o_orderkey"], 7)
        .groupBy("fold")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        ),
        """SELECT ntile AS fold, count(*) AS n, min(o_orderkey) AS first_key,
        max(o_orderkey) AS last_key
        FROM (SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey) AS ntile FROM orders)
        GROUP BY 1""",
    ),
}

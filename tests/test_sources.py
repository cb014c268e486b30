"""Readers, writers, catalog tables and messages on edge rows."""

import gzip
import hashlib
import json
import os
import tempfile
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite import sources
from suite.tables import Tables
from tidemark.operators.position import chunk_rows, kfold, with_position
from tidemark.session import new_location
from tidemark.sources import files
from tidemark.sources.export import export_files
from tidemark.sources.files import BadRecords, read_delimited, read_ndjson, text_after_rows
from tidemark.sources.jdbc import jdbc_options
from tidemark.sources.load import load_files
from tidemark.sources.messages import NotAllSent, send_batches, send_rows
from tidemark.sources.rows import rows_to_json, rows_to_vector
from tidemark.sources.schema import PREDICTION_SCHEMAS, schema_from_file, schema_from_json
from tidemark.sources.warehouse import CREATE_NEVER, WRITE_EMPTY, WRITE_TRUNCATE, Warehouse

AB = T.StructType().add("a", "integer").add("b", "string")


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def house(spark):
    return Warehouse(spark, f"tm_{uuid.uuid4().hex}", new_location(spark, "warehouse"))


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write(text)
    return path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_strict_csv_fails_on_a_bad_record(spark, folder):
    path = put(folder, "x.csv", "1,x\nnope,y\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_delimited(spark, path, AB).collect()


def test_bad_record_limit(spark, folder):
    path = put(folder, "x.csv", "1,x\nnope,y\n3,z\nbad,w\n")
    found = read_delimited(spark, path, AB, bad_record_limit=2)
    assert rows(found) == [(1, "x"), (3, "z")] and found.count() == 2
    with pytest.raises(BadRecords):
        read_delimited(spark, path, AB, bad_record_limit=1)


def test_uneven_rows(spark, folder):
    path = put(folder, "x.csv", '1\n2,"b,c"\n3,d,extra\n4,"e,f",g,h\n')
    jagged = dict(allow_jagged_rows=True, ignore_unknown_values=True)
    assert rows(read_delimited(spark, path, AB, **jagged)) == [
        (1, None), (2, "b,c"), (3, "d"), (4, "e,f"),
    ]
    with pytest.raises(BadRecords):
        read_delimited(spark, path, AB, allow_jagged_rows=True)
    assert rows(read_delimited(spark, path, AB, allow_jagged_rows=True, bad_record_limit=2)) == [
        (1, None), (2, "b,c"),
    ]


def test_repaired_rows_still_check_types(spark, folder):
    path = put(folder, "x.csv", "nope\n2,b\n")
    with pytest.raises(BadRecords):
        read_delimited(spark, path, AB, allow_jagged_rows=True)


def test_quoted_newlines_and_delimiters(spark, folder):
    path = put(folder, "x.csv", "a|b\n1|'two\nlines'\n2|'p|q'\n")
    found = read_delimited(
        spark, path, AB, delimiter="|", quote="'", skip_leading_rows=1, allow_quoted_newlines=True
    )
    assert rows(found) == [(1, "two\nlines"), (2, "p|q")]


def test_skip_several_rows_in_every_file(spark, folder):
    put(folder, "one.csv", "# head\n# more\na,b\n1,x\n2,y\n")
    put(folder, "two.csv", "## head\n## more\na,b\n3,z\n")
    assert rows(read_delimited(spark, folder, AB, skip_leading_rows=3)) == [(1, "x"), (2, "y"), (3, "z")]
    put(folder, "short.csv", "only\n")
    with pytest.raises(Exception, match="fewer lines"):
        text_after_rows(spark, folder, 3).collect()


def test_skip_rows_across_many_blocks(spark, folder):
    put(folder, "big.txt", "".join(f"line {i}\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        left = text_after_rows(spark, folder, 7)
        assert left.count() == 50_000 - 7
        assert left.filter("value in ('line 6', 'line 7')").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inferred_csv(spark, folder):
    path = put(folder, "x.csv", "a,b\n1,x\n")
    found = read_delimited(spark, path, skip_leading_rows=1)
    assert dict(found.dtypes) == {"a": "int", "b": "string"}


def test_json_lines(spark, folder):
    path = put(folder, "x.json", '{"a": 1, "b": "x", "c": 5}\n{"a": 2}\n')
    assert rows(read_ndjson(spark, path, AB)) == [(1, "x"), (2, None)]
    with pytest.raises(BadRecords):
        read_ndjson(spark, path, AB, ignore_unknown_values=False)
    assert rows(read_ndjson(spark, path, AB, bad_record_limit=1, ignore_unknown_values=False)) == [(2, None)]
    bad = put(folder, "y.json", '{"a": 1}\n{broken\n')
    assert rows(read_ndjson(spark, bad, AB, bad_record_limit=1)) == [(1, None)]
    assert set(read_ndjson(spark, path).columns) == {"a", "b", "c"}


def test_schema_defaults(folder):
    entries = [
        {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "price", "type": "NUMERIC", "description": "net"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
        {"name": "pair", "type": "RECORD", "fields": [{"name": "x", "type": "FLOAT"}]},
        {"name": "list", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "d", "type": "DATE"}]},
    ]
    schema = schema_from_json(entries)
    assert [f.nullable for f in schema.fields] == [False, True, True, True, True]
    assert schema["price"].dataType == T.DecimalType(38, 9)
    assert schema["price"].metadata == {"description": "net"} and schema["id"].metadata == {"description": ""}
    assert schema["tags"].dataType == T.ArrayType(T.StringType())
    assert schema["list"].dataType.elementType["d"].dataType == T.DateType()
    path = put(folder, "schema.json", json.dumps(entries))
    assert schema_from_file(path) == schema
    with pytest.raises(ValueError):
        schema_from_json([{"name": "x", "type": "GEOMETRY"}])
    assert PREDICTION_SCHEMAS["survival"]["model_value"].dataType.elementType.fieldNames() == ["measure", "value"]


def test_dispositions(spark, house):
    df = spark.createDataFrame([(1, "x")], AB)
    with pytest.raises(ValueError):
        house.write(df, "t", create=CREATE_NEVER)
    house.write(df, "t")
    assert house.write(df, "t").count() == 2
    with pytest.raises(ValueError):
        house.write(df, "t", write=WRITE_EMPTY)
    assert house.write(df, "t", write=WRITE_TRUNCATE).count() == 1
    house.delete_rows("t")
    assert house.table("t").columns == ["a", "b"] and house.table("t").isEmpty()
    assert house.write(df, "t", write=WRITE_EMPTY).count() == 1
    with pytest.raises(ValueError):
        house.delete_rows("nothing")
    house.create("fresh", AB)
    house.create("fresh", AB)
    with pytest.raises(ValueError, match="no rows"):
        house.copy("fresh", "copied")


def test_day_partitions(spark, house):
    df = spark.createDataFrame(
        [(i, datetime(2024, 1, i, 5)) for i in range(1, 11)] + [(99, None)], "id int, at timestamp"
    )
    house.write_by_day(df, "t", "at")
    text = house.table("t").filter("day = '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    assert house.expire_days("t", 3, as_of=date(2024, 1, 10)) == 6
    assert {r["id"] for r in house.table("t").collect()} == {7, 8, 9, 10, 99}
    house.create("empty_by_day", df.schema, "at")
    assert house.table("empty_by_day").columns == ["id", "at", "day"]


def test_export(spark, folder):
    df = spark.range(100).repartition(4)
    export_files(df, f"{folder}/one", "CSV", "GZIP", split_files=False)
    assert len([f for f in os.listdir(f"{folder}/one") if f.endswith(".csv.gz")]) == 1
    export_files(df, f"{folder}/many", "NEWLINE_DELIMITED_JSON", max_records_per_file=10)
    assert len([f for f in os.listdir(f"{folder}/many") if f.endswith(".json")]) >= 10
    with pytest.raises(ValueError):
        export_files(df, f"{folder}/no", "AVRO")


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "select 1", split_column="k", lower=0, upper=9, partitions=4)
    assert options["dbtable"] == "(select 1) q" and options["numPartitions"] == "4"
    assert options["fetchsize"] == "1000000"
    assert jdbc_options("jdbc:x", "select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "select 1", partitions=4)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "select 1", split_column="k", partitions=4)


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], AB)
    assert json.loads(rows_to_json(df).first()[0]) == {"a": 1, "b": None}
    assert [r[0] for r in rows_to_vector(spark.createDataFrame([(1, 2), (3, 4)], "x int, y int")).collect()] == [1, 2, 3, 4]


def test_message_batches(spark, folder):
    def open_sender():
        def send(entries):
            assert [e["Id"] for e in entries] == [str(i) for i in range(len(entries))]
            assert len(entries) <= 10
            return [e["Id"] for e in entries if json.loads(e["MessageBody"])["id"] == 13]

        return send

    df = spark.range(95).coalesce(1)
    outcome = send_batches(df, open_sender).collect()
    assert sorted(r["sent"] for r in outcome) == [5] + [10] * 9
    assert send_rows(df, open_sender) == {"sent": 95, "received": 94, "failed": 1}
    with pytest.raises(NotAllSent):
        send_rows(df, open_sender, batch=False)
    assert send_rows(df.limit(5), open_sender, batch=False)["received"] == 5


def test_equal_rows_are_different_messages_and_a_repeat_is_the_same(spark, folder):
    def open_sender():
        def send(entries):
            with open(f"{folder}/sent.txt", "a") as out:
                out.writelines(f"{e['DeduplicationId']}\n" for e in entries)
            return []

        return send

    outcome = send_batches(spark.createDataFrame([(1,), (1,), (2,)], "x int").coalesce(1), open_sender)
    for _ in range(2):  # as a retried task would
        assert outcome.agg(F.sum("received").alias("n")).first()["n"] == 3
    keys = open(f"{folder}/sent.txt").read().split()
    assert len(keys) == 6 and len(set(keys)) == 3


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    placed = with_position(df, ["k"])
    assert placed.filter("k <> position").isEmpty() and placed.count() == 1000
    sizes = [r["count"] for r in chunk_rows(df, ["k"], chunks=7).groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [143] * 6 + [142]
    assert chunk_rows(df, ["k"], batch_size=300).select("chunk").distinct().count() == 4
    folds = [r["count"] for r in kfold(df.limit(103), ["k"], 5).groupBy("fold").count().orderBy("fold").collect()]
    assert folds == [21, 21, 21, 20, 20]
    with pytest.raises(ValueError):
        kfold(df.limit(3), ["k"], 5)


def test_positions_with_one_leading_value_for_most_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("hot"), "id")
    placed = with_position(df, ["hot", "id"]).collect()
    assert [r["position"] for r in sorted(placed, key=lambda r: (r["hot"], r["id"]))] == list(range(3000))


def test_load_files_by_day_with_expiry(spark, folder, house):
    path = put(folder, "x.csv", "".join(f"{i},2024-01-{i:02d} 05:00:00\n" for i in range(1, 11)))
    schema = T.StructType().add("id", "integer").add("at", "timestamp")
    table = load_files(
        house, "t", path, "CSV", schema, date_partition_column="at", date_partition_expiration_days=2
    )
    assert sorted(r["id"] for r in table.collect()) == [8, 9, 10]
    assert load_files(house, "t", path, "CSV", schema, date_partition_column="at").count() == 13
    lines = put(folder, "x.json", '{"id": 1}\n')
    assert load_files(house, "j", lines, "NEWLINE_DELIMITED_JSON", autodetect=True).count() == 1
    with pytest.raises(ValueError):
        load_files(house, "j", lines, "AVRO", autodetect=True)
    with pytest.raises(ValueError):
        load_files(house, "j", lines, "CSV")


def test_inferred_loads_keep_the_limit(spark, folder):
    def put(name, text):
        with open(f"{folder}/{name}", "w") as file:
            file.write(text)

    put("b.csv", "id,name\n1,a\n2,b\n3\n")
    with pytest.raises(Exception):
        read_delimited(spark, f"{folder}/b.csv", skip_leading_rows=1).collect()
    kept = read_delimited(spark, f"{folder}/b.csv", skip_leading_rows=1, bad_record_limit=1)
    assert [tuple(r) for r in kept.orderBy("id").collect()] == [(1, "a"), (2, "b")]
    put("b.json", '{"id": 1}\n{"id": 2}\n{broken\n')
    with pytest.raises(Exception):
        read_ndjson(spark, f"{folder}/b.json").collect()
    kept = read_ndjson(spark, f"{folder}/b.json", bad_record_limit=1)
    assert kept.columns == ["id"] and sorted(r.id for r in kept.collect()) == [1, 2]


@pytest.mark.parametrize("few", [0, 10])
def test_texts_of_one_id_are_one_file(spark, folder, monkeypatch, few):
    monkeypatch.setattr(sources, "FEW_IDS", few)
    rows = [(i % 90 if i < 100 else None, f"text {i}") for i in range(102)]
    n = sources.write_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), f"file:{folder}/texts")
    found = {r["file_name"]: sorted(r["text"].splitlines()) for r in files.read_text_files(spark, f"{folder}/texts").collect()}
    wanted = {f"doc_id={i}.txt": sorted(t for k, t in rows if k == i) for i in {k for k, _ in rows}}
    assert found == wanted and n == len(wanted) == 91


def test_a_file_per_document_needs_no_folder_per_document(spark, folder, monkeypatch):
    """Spark's reader lists folder by folder: 10,000 took it half a minute."""
    path = f"file:{folder}/texts"
    monkeypatch.setattr(sources, "new_location", lambda *_: path)
    rows = [(i, f"text {i}\r\n\nend\n\n") for i in range(400)] + [(1000, None), (1001, ""), (1002, "a"), (1002, "a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    found = sources.text_files(Tables(spark, folder)).collect()
    wanted = {i: f"text {i}\n\nend" for i in range(400)} | {1000: "", 1001: "", 1002: "a\na"}
    assert sorted(tuple(r) for r in found) == [(i, hashlib.md5(x.encode()).hexdigest()) for i, x in sorted(wanted.items())]
    assert sum(1 for _ in os.walk(f"{folder}/texts")) < 50


def spark_reads(spark, path):
    columns = [F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")]
    return spark.read.text(path, wholetext=True).select(columns)


def test_no_list_of_files_in_the_driver(spark, folder, monkeypatch):
    """Spark's reader keeps the status of every file there."""
    for name in ("a.txt", "b c%.txt", "é#[1].txt", "_hidden", ".hidden", "z._COPYING_", "_k=v", "empty.txt"):
        with open(f"{folder}/{name}", "wb") as file:
            file.write(b"" if name == "empty.txt" else f"{name}\r\n".encode() + b"\xff")
    for i in range(30):
        os.makedirs(f"{folder}/../{os.path.basename(folder)}-parts/k={i}")
        with open(f"{folder}/../{os.path.basename(folder)}-parts/k={i}/a.txt", "w") as file:
            file.write(f"{i}\n")
    by_bytes = lambda rows: sorted((r["file_name"], r["path"], r["b"]) for r in rows.select("file_name", "path", F.hex("text").alias("b")).collect())
    paths = [folder, f"file:{folder}", f"{folder}-parts"]
    wanted = [by_bytes(spark_reads(spark, p)) for p in paths]
    monkeypatch.setattr(files, "BATCH_NAMES", 3)
    monkeypatch.setattr(files, "BATCH_BYTES", 20)
    monkeypatch.setattr(files, "TASK_BYTES", 5 * files.OPEN_BYTES)

    def refuse(*_, **__):
        raise AssertionError("listed by the driver")

    monkeypatch.setattr(type(spark.read), "text", refuse)
    assert [by_bytes(files.read_text_files(spark, p)) for p in paths] == wanted
    assert [len(w) for w in wanted] == [4, 4, 30]


def test_other_folders_of_texts_are_read_by_spark(spark, folder):
    def put(name, data):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as file:
            file.write(data)

    put("packed/a.txt", b"a")
    put("packed/b.txt.gz", gzip.compress(b"b"))
    put("below/a.txt", b"a")
    put("below/sub/b.txt", b"b")
    put("mixed/a.txt", b"a")
    put("mixed/k=1/b.txt", b"b")
    put("deep/k=1/j=2/b.txt", b"b")
    for path, n in (("packed", 2), ("below", 1), ("mixed", 1), ("deep", 1), ("packed/a.txt", 1), ("deep/k=*/*", 1)):
        found = files.read_text_files(spark, f"{folder}/{path}")
        assert sorted(found.collect()) == sorted(spark_reads(spark, f"{folder}/{path}").collect()) and found.count() == n


def test_no_documents_no_files(spark, folder):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    assert sources.text_files(Tables(spark, folder)).isEmpty()

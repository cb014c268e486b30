"""Delimited, JSON and text files as DataFrames."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import written

CORRUPT = "_corrupt_record"
SMALLEST_LONG = -(2**63)
#: Bytes of text files that a task reads, about, and those that opening a file counts as.
TASK_BYTES, OPEN_BYTES = 128 << 20, 16 << 10
#: Bytes of text that a task hands on at once, and names that it lists at once.
BATCH_BYTES, BATCH_NAMES = 4 << 20, 10_000


class BadRecords(ValueError):
    """More unreadable records than the load allows."""


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _within_limit(parsed: DataFrame, limit: int) -> DataFrame:
    """Drop unreadable rows, or fail when there are more than ``limit``.

    Spark parses only referenced columns, so both uses of the marker also touch a hash
    of all others: a record is judged whole.
    """
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c in parsed.columns if c != CORRUPT])
    marker = F.col(CORRUPT)
    bad = parsed.filter(marker.isNotNull()).select(whole_row.alias("row")).limit(limit + 1)
    found = bad.agg(F.count("row").alias("n"), F.bit_xor("row").alias("x")).first()["n"]
    if found > limit:
        raise BadRecords(f"more than {limit} bad records")
    any_hash = whole_row >= F.lit(SMALLEST_LONG)
    good = parsed.filter(marker.isNull() & any_hash) if found else parsed
    return good.drop(CORRUPT)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    delimiter: str = ",",
    quote: str = '"',
    skip_leading_rows: int = 0,
    bad_record_limit: int = 0,
    allow_quoted_newlines: bool = False,
    allow_jagged_rows: bool = False,
    ignore_unknown_values: bool = False,
) -> DataFrame:
    """Rows of delimited files.

    Without a schema, types are inferred first; the limit then holds for what was inferred.
    A limit of 0 lets the first bad record fail
    the job that reads it, at no extra cost; a higher limit counts bad records first
    (stopping one past the limit) and then leaves them out. Missing trailing values
    and surplus values make a record bad unless allowed.
    """
    if skip_leading_rows > 1:
        if allow_quoted_newlines:
            raise ValueError("skipping several rows does not combine with quoted newlines")
        if schema is None:
            raise ValueError("skipping several rows needs a schema")
    options = {"sep": delimiter, "quote": quote, "columnPruning": "false"}
    if schema is None:
        reader = spark.read.options(**options).option("inferSchema", "true")
        schema = reader.csv(
            path, header=skip_leading_rows == 1, multiLine=allow_quoted_newlines
        ).schema
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    lenient = allow_jagged_rows or ignore_unknown_values
    if bad_record_limit == 0 and not lenient and skip_leading_rows <= 1:
        return (
            spark.read.schema(schema)
            .options(mode="FAILFAST", **options)
            .csv(path, header=skip_leading_rows == 1, multiLine=allow_quoted_newlines,
                 enforceSchema=True)
        )
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    permissive = {
        **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
        "enforceSchema": "true",
    }
    if skip_leading_rows > 1:
        lines = text_after_rows(spark, path, skip_leading_rows)
        parsed = lines.select(
            F.from_csv("value", _ddl(marked), permissive).alias("r")
        ).select("r.*")
    else:
        parsed = (
            spark.read.schema(marked)
            .options(**permissive)
            .csv(path, header=skip_leading_rows == 1, multiLine=allow_quoted_newlines)
        )
    if lenient:
        parsed = _reread_uneven(
            parsed, schema, permissive, delimiter, quote, allow_jagged_rows, ignore_unknown_values
        )
    return _within_limit(parsed, bad_record_limit)


def _reread_uneven(
    parsed: DataFrame, schema: T.StructType, options: dict, delimiter: str, quote: str,
    allow_jagged_rows: bool, ignore_unknown_values: bool,
) -> DataFrame:
    """Give records with too few or too many values a second reading.

    Only records that failed the first reading are touched: missing separators are
    appended, surplus values cut off, and the line is parsed again. A record that
    still fails stays marked.
    """
    sep, quo = re.escape(delimiter), re.escape(quote)
    value = f"(?:{quo}(?:[^{quo}]|{quo}{quo})*{quo}|[^{sep}]*)"
    wanted = len(schema.fields)
    line = F.col(CORRUPT)
    plain = F.regexp_replace(line, f"{quo}(?:[^{quo}]|{quo}{quo})*{quo}", "")
    values = F.length(plain) - F.length(F.replace(plain, F.lit(delimiter), F.lit("")))
    values = values / len(delimiter) + 1
    repaired = line
    if allow_jagged_rows:
        padding = F.repeat(F.lit(delimiter), (F.lit(wanted) - values).cast("int"))
        repaired = F.when(values < wanted, F.concat(line, padding)).otherwise(repaired)
    if ignore_unknown_values:
        leading = F.regexp_extract(line, f"^({value}(?:{sep}{value}){{{wanted - 1}}})", 1)
        repaired = F.when(values > wanted, leading).otherwise(repaired)
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    again = F.from_csv(repaired, _ddl(marked), options)
    names = marked.fieldNames()
    second = parsed.withColumn("_again", F.when(line.isNotNull(), again))
    return second.select(
        *[
            F.when(line.isNotNull(), F.col(f"_again.`{n}`")).otherwise(F.col(f"`{n}`")).alias(n)
            for n in names
        ]
    )


def text_after_rows(spark: SparkSession, path: str | list[str], rows: int) -> DataFrame:
    """Lines of text files without the first ``rows`` lines of each file.

    The first block of a file is read by one task from its first line on, so a line's
    number is its running id minus the smallest id of that block. The skipped lines
    must lie within the first block.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    first_block = F.col("block") == 0
    starts = (
        lines.filter(first_block)
        .groupBy("file")
        .agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"))
        .select(
            "file",
            F.when(
                F.col("last_line") - F.col("first_line") + 1 >= rows, F.col("first_line")
            ).alias("first_line"),
        )
    )
    too_short = F.raise_error(F.lit("a file's first block has fewer lines than are skipped"))
    number = F.col("line") - F.coalesce(F.col("first_line"), too_short.cast("long"))
    return (
        lines.join(F.broadcast(starts), "file", "left")  # one row per file
        .filter(~first_block | (number >= rows))
        .select("value")
    )


def read_ndjson(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    bad_record_limit: int = 0,
    ignore_unknown_values: bool = True,
) -> DataFrame:
    """Rows of newline-delimited JSON; without a schema, types are inferred from the lines that
    are JSON, and the limit holds for the others.

    Unknown fields are ignored, or make a record bad when ``ignore_unknown_values``
    is off.
    """
    if schema is None:
        schema = spark.read.option("mode", "DROPMALFORMED").json(path).schema
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    if ignore_unknown_values and bad_record_limit == 0:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if ignore_unknown_values:
        return _within_limit(spark.read.schema(marked).options(**options).json(path), bad_record_limit)
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    parsed = (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select("value", F.from_json("value", marked, options).alias("r"))
    )
    surplus = F.size(F.array_except(F.json_object_keys("value"), known)) > 0
    parsed = parsed.select(
        *[F.col(f"r.`{f.name}`") for f in schema.fields],
        F.when(surplus, F.col("value")).otherwise(F.col(f"r.{CORRUPT}")).alias(CORRUPT),
    )
    return _within_limit(parsed, bad_record_limit)


def csv_to_ndjson(spark: SparkSession, source: str, target: str) -> None:
    """Delimited files with a header as JSON lines; every value stays text."""
    rows = spark.read.csv(source, header=True, inferSchema=False)
    rows.write.option("ignoreNullFields", "false").json(target)


def read_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``(file_name, path, text)`` per file that is not empty, text whole.

    Tasks list and read the files, of a folder or of its ``key=value`` folders, so that no list of
    them lies in the driver, as it does with Spark's reader. That one reads any other layout, compressed
    files, and what pyarrow does not open.
    """
    found = _listed(spark, folder)
    if found is None:
        return spark.read.text(folder, wholetext=True).select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_path").alias("path"),
            F.col("value").alias("text"),
        )
    names, uri = found
    size = names.agg(F.sum(F.col("size") + OPEN_BYTES)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(uri)
        for batch in batches:
            done, texts, held = [], [], 0
            for name in batch.column("name").to_pylist():
                with files.open_input_file(f"{root}/{name}") as file:
                    texts.append(file.read())
                done.append(_in_uri(name))
                held += len(texts[-1])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(done), pa.array(texts, pa.binary())], ["name", "text"])
                    done, texts, held = [], [], 0
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done), pa.array(texts, pa.binary())], ["name", "text"])

    rows = names.repartition(tasks, "name").mapInArrow(read, "name string, text binary")
    return rows.select(
        F.substring_index("name", "/", -1).alias("file_name"),
        F.concat(F.lit(f"{uri}/"), "name").alias("path"),
        F.col("text").cast("string").alias("text"),
    )


def _in_uri(name: str) -> str:
    """A path as it stands in a URI of Java's: only what is not allowed there is quoted."""
    return re.sub(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0]|[^\S ]""", lambda m: quote(m[0], safe=""), name)


def _entries(files: FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """Name, whether it is a folder, and size of what Spark's readers see in a folder."""
    if isinstance(files, LocalFileSystem):
        with os.scandir(folder) as found:
            every = ((e.name, e.is_dir(), e.stat().st_size) for e in found if _seen(e.name))
            yield from every
    else:
        for info in files.get_file_info(FileSelector(folder)):
            if _seen(info.base_name):
                yield info.base_name, info.type == FileType.Directory, info.size or 0


def _seen(name: str) -> bool:
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _listed(spark: SparkSession, folder: str) -> tuple[DataFrame, str] | None:
    """Names and sizes of the files in a folder, or in its ``key=value`` folders, listed by tasks, and its URI.

    None for what only Spark's reader can read.
    """
    if re.search(r"[{}\[\]*?\\]", folder):  # a pattern
        return None
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = re.sub("^file:///", "file:/", path.getFileSystem(conf).makeQualified(path).toUri().toString())
    try:
        files, root = FileSystem.from_uri(uri)
        if files.get_file_info(root).type != FileType.Directory:
            return None
    except (pa.ArrowException, OSError):
        return None
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    packed = tuple(spark._jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(uri)
        for batch in batches:
            for parent in batch.column("name").to_pylist():
                held = []
                for name, is_folder, size in _entries(files, f"{root}/{parent}"):
                    held.append((f"{parent}/{name}".lstrip("/"), is_folder, size, name.endswith(packed)))
                    if len(held) == BATCH_NAMES:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held, strict=True)], kinds.names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held, strict=True)], kinds.names)

    kinds = T.StructType().add("name", "string").add("is_folder", "boolean").add("size", "long").add("packed", "boolean")

    def listed(folders: DataFrame) -> tuple[DataFrame, int, int, list]:
        found = written(folders.mapInArrow(below, kinds), "files")
        key = F.regexp_extract("name", r"^([^/=]+)=[^/]+$", 1)  # empty for a folder without one
        some = found.agg(F.count_if("is_folder"), F.count_if(~F.col("is_folder")), F.collect_set(F.when(F.col("is_folder"), key)), F.max("packed")).first()
        return found, *some

    names, folders, n, keys, any_packed = listed(spark.createDataFrame([("",)], "name string"))
    if folders:
        if n or len(keys) > 1 or not keys[0]:
            return None
        dealt = names.select("name").repartition(min(folders, 4 * spark.sparkContext.defaultParallelism))
        names, folders, n, keys, any_packed = listed(dealt)
        if folders:
            return None
    if any_packed:
        return None
    return names.filter("size > 0").select("name", "size"), uri

"""Upserts into a prediction table without a transactional table format.

Rows live in ``<table>__data``, partitioned by submodel, bucket of the key and version. The
table ``<table>__versions`` says which version of each bucket is current; every write adds a
new generation of it. A merge rewrites only the buckets whose keys its source holds; the view
``<table>`` joins rows to one generation and is replaced in one catalog step, so readers see
the table before or after a merge, never in between.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written
from tidemark.sources.warehouse import Warehouse

SLICE = "submodel_name"
BUCKET, VERSION, BUCKETS, GENERATION = "_bucket", "_version", "_buckets", "_generation"
#: Rows of one bucket, about: what a merge of one row rewrites. A submodel gets more buckets when
#: it has outgrown its own by ``REGROW``.
BUCKET_ROWS, REGROW = 1_000_000, 4
#: Partitions of one DROP statement.
DROPPED_AT_ONCE = 2000


class DuplicateKeys(ValueError):
    """The source holds a key more than once."""


def merged_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with no match in the source, and all source rows."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(
        source.select(*target.columns)
    )


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    repeated = source.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise DuplicateKeys(f"source rows repeat their key ({', '.join(keys)})")


def _quoted(text: object) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


class VersionedTable:
    """A table of predictions keyed by ``(key, submodel_name)``.

    One writer at a time. A write that breaks off leaves the view as it was; running it
    again overwrites the unfinished version. Rows need a submodel; nothing about submodels or
    buckets but the partitions to drop comes to the driver.
    """

    def __init__(self, house: Warehouse, table: str, key: str = "id", bucket_rows: int = BUCKET_ROWS):
        self.house = house
        self.table = table
        self.data = f"{table}__data"
        self.versions = f"{table}__versions"
        self.key = key
        self.keys = [key, SLICE]
        self.bucket_rows = bucket_rows

    def read(self) -> DataFrame:
        return self.house.table(self.table)

    def generation(self) -> int:
        """Number of the write that the view shows, 0 before the first."""
        if not self.house.exists(self.table):
            return 0
        stored = self.house.spark.sql(f"SHOW TBLPROPERTIES {self.house.name(self.table)} ('generation')")
        return int(stored.first()["value"])

    def current(self) -> DataFrame:
        """Submodel, number of buckets, bucket and version of all the view shows."""
        number = self.generation()
        if not number:
            return self.house.spark.createDataFrame([], f"{SLICE} string, {BUCKETS} int, {BUCKET} int, {VERSION} int")
        return self.house.table(self.versions).filter(F.col(GENERATION) == number).drop(GENERATION)

    def _sized(self, counts: DataFrame, name: str) -> DataFrame:
        """Submodels with as many buckets as their rows need."""
        need = F.greatest(F.ceil(F.col("rows") / self.bucket_rows), F.lit(1)).cast("int")
        return counts.select(SLICE, need.alias(name))

    def _dealt(self, rows: DataFrame, layout: DataFrame) -> DataFrame:
        """Rows with the bucket of their key."""
        bucket = F.pmod(F.xxhash64(self.key), F.col(BUCKETS).cast("long")).cast("int")
        return rows.join(layout.select(SLICE, BUCKETS), SLICE).withColumn(BUCKET, bucket)

    def merge(self, source: DataFrame) -> DataFrame:
        """Replace rows whose key the source holds, insert the others."""
        rows = written(source, "merge-source")
        if not rows.filter(F.col(SLICE).isNull()).isEmpty():
            raise ValueError(f"source rows without {SLICE}")
        require_unique(rows, self.keys)
        if not self.generation():
            return self._load(rows)
        current, stored = self.current(), self.house.table(self.data)
        counts = rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows"))
        # only partition columns are read: the counts come from file footers
        held = stored.join(current.join(counts, SLICE, "left_semi"), [SLICE, BUCKET, VERSION]).groupBy(SLICE).agg(F.count(F.lit(1)).alias("held"))
        need = counts.join(held, SLICE, "left").select(SLICE, (F.col("rows") + F.coalesce("held", F.lit(0))).alias("rows"))
        have = current.groupBy(SLICE).agg(F.max(BUCKETS).alias("have"))
        layout = self._sized(need, "need").join(have, SLICE, "left")
        grows = F.col("have").isNull() | (F.col("need") > REGROW * F.col("have"))
        layout = written(layout.select(SLICE, F.when(grows, F.col("need")).otherwise(F.col("have")).alias(BUCKETS), (grows & F.col("have").isNotNull()).alias("regrown")), "merge-layout")
        dealt = self._dealt(rows, layout)
        touched = dealt.select(SLICE, BUCKET).distinct()
        regrown = layout.filter("regrown").select(SLICE)
        replaced = current.join(touched, [SLICE, BUCKET], "left_semi").unionByName(current.join(regrown, SLICE, "left_semi")).distinct()
        replaced = written(replaced, "merge-replaced")
        target = stored.join(replaced.select(SLICE, BUCKET, VERSION), [SLICE, BUCKET, VERSION]).select(*rows.columns)
        result = self._dealt(merged_rows(target, rows, self.keys), layout)
        kept = current.join(replaced.select(SLICE, BUCKET), [SLICE, BUCKET], "left_anti")
        self._store(result, rows.columns, kept)
        self._drop(replaced)
        return self.read()

    def truncate_load(self, source: DataFrame) -> DataFrame:
        """Replace the whole table."""
        replaced = written(self.current(), "load-replaced")
        self._load(written(source, "load-source"))
        self._drop(replaced)
        return self.read()

    def _load(self, rows: DataFrame) -> DataFrame:
        layout = self._sized(rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows")), BUCKETS)
        self._store(self._dealt(rows, layout), rows.columns, None)
        return self.read()

    def _store(self, dealt: DataFrame, columns: Sequence[str], kept: DataFrame | None) -> None:
        """Write new versions of the buckets of ``dealt`` and show them, with those ``kept``."""
        before = self.generation()
        number = before + 1
        place = [SLICE, BUCKET, VERSION]
        result = dealt.withColumn(VERSION, F.lit(number))
        self.house.replace_slices(result.select(*(c for c in columns if c != SLICE), *place).hint("rebalance", *place), self.data, place)
        fresh = dealt.select(SLICE, BUCKETS, BUCKET).distinct().withColumn(VERSION, F.lit(number))
        parts = [fresh] if kept is None else [kept, fresh]
        listed = reduce(DataFrame.unionByName, parts).withColumn(GENERATION, F.lit(number))
        self.house.replace_slices(listed.coalesce(1), self.versions, [GENERATION])
        chosen = ", ".join(f"d.`{c}`" for c in columns)
        same = " AND ".join(f"d.{c} = v.{c}" for c in place)
        self.house.spark.sql(
            f"CREATE OR REPLACE VIEW {self.house.name(self.table)} TBLPROPERTIES ('generation' = '{number}') AS "
            f"SELECT {chosen} FROM {self.house.name(self.data)} d JOIN {self.house.name(self.versions)} v ON {same} WHERE v.{GENERATION} = {number}"
        )
        if before:
            self.house.drop_slice(self.versions, **{GENERATION: before})

    def _drop(self, replaced: DataFrame) -> None:
        """Replaced versions leave after the view no longer shows them, many to a statement."""
        specs: list[str] = []

        def flush() -> None:
            if specs:
                self.house.spark.sql(f"ALTER TABLE {self.house.name(self.data)} DROP IF EXISTS {', '.join(specs)}")
                specs.clear()

        for r in replaced.select(SLICE, BUCKET, VERSION).toLocalIterator():
            specs.append(f"PARTITION ({SLICE}={_quoted(r[SLICE])}, {BUCKET}={r[BUCKET]}, {VERSION}={r[VERSION]})")
            if len(specs) >= DROPPED_AT_ONCE:
                flush()
        flush()


def write_predictions(
    house: Warehouse, df: DataFrame, table: str, method: str = "merge", key: str = "id"
) -> DataFrame:
    """Store prediction records by ``merge`` (upsert) or ``truncate`` (replace all)."""
    target = VersionedTable(house, table, key)
    if method == "merge":
        return target.merge(df)
    if method == "truncate":
        return target.truncate_load(df)
    raise ValueError(f"unknown write method {method}, use merge or truncate")

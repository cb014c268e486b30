"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Runtime SQL settings every plan in this package relies on.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a dominant join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tables dealt by one of their join keys (the customer) meet without another shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # collect_set keeps a few short values per (date, customer) group: stay on the
    # hash path for far more groups than the default of 128 before sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package's runtime settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of about ``size`` bytes (one longer row goes alone).

    Spark's own limit is 10,000 rows, whose bytes both the executor and its Python workers hold.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a fresh
    temporary folder. On a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidemark-{application_id}-")


def new_location(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses.

    Paths of one application share a folder, which may go when the application is done.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``options`` are the writer's.

    Later jobs start from the files, so lost executors do not replay the plan and
    non-deterministic inputs cannot change between two uses of the result.
    """
    path = new_location(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opened(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at ``path``; an absent one is created without rows."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)

"""Results of SQL databases, read by many tasks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per fetch.
FETCH_SIZE = 1_000_000


def jdbc_options(
    url: str,
    query: str,
    driver: str | None = None,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = FETCH_SIZE,
    **properties: str,
) -> dict[str, str]:
    """Reader options; a split column turns the read into ``partitions`` range queries."""
    options = {"url": url, "fetchsize": str(fetch_size), **properties}
    if driver:
        options["driver"] = driver
    if split_column is None:
        if partitions != 1:
            raise ValueError("several partitions need a split column with its bounds")
        return {**options, "query": query}
    if lower is None or upper is None:
        raise ValueError("a split column needs its lower and upper bound")
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": split_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, query: str, **settings) -> DataFrame:
    """Rows of ``query``; see ``jdbc_options`` for the settings."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **settings)).load()

"""Relational sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def bounds_query(table: str, column: str) -> str:
    """The one-row query that gives a partitioned read its range."""
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"


def read_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options; with ``column`` and ``bounds`` the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "preferTimestampNTZ": "true", **(properties or {})}
    if column and bounds and partitions > 1:
        low, high = bounds
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(max(high, low + 1)),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A whole table. Given a numeric ``column``, its range is asked for once and the rows are
    fetched by ``partitions`` connections; rows with a null there belong to the first."""
    bounds = None
    if column and partitions > 1:
        query = {"url": url, "query": bounds_query(table, column), **(properties or {})}
        low, high = spark.read.format("jdbc").options(**query).load().first()
        bounds = None if low is None else (int(low), int(high))
    options = read_options(url, table, properties, column, bounds, partitions)
    return spark.read.format("jdbc").options(**options).load()

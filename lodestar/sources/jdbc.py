"""JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 8,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Partitioned JDBC read: ``partitions`` range queries on a numeric column run
    in parallel instead of one connection pulling the whole table (S23)."""
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=props,
    )


def query_jdbc(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    """Result of a query run by the database."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()

"""Catalog tasks (S09-S22): views, cache, materialise, persistent tables, SQL, DDL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from lodestar.session import checkpoint_dir


def table(spark: SparkSession, name: str) -> DataFrame:
    """Reference to a catalog table or view."""
    return spark.table(name)


def upload(spark: SparkSession, rows, schema, name: str | None = None) -> DataFrame:
    """Local rows to a DataFrame (+ view) (S10).  The rows are held by the
    driver; large data should be read by Spark from storage."""
    df = spark.createDataFrame(list(rows), schema)
    if name:
        df.createOrReplaceTempView(name)
    return df


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a lazy query (S11); a view is re-evaluated unless cached."""
    df.createOrReplaceTempView(name)
    return df


def cache_table(spark: SparkSession, name: str, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Cache a table or view by name, qualified or not (S12); memory and disk so eviction spills, not recomputes."""
    spark.catalog.cacheTable(name, level)
    return spark.table(name)


def materialise(df: DataFrame, name: str | None = None) -> DataFrame:
    """``compute()``: run the query once into the shared checkpoint folder and
    register the result (S13).  A reliable checkpoint survives executor loss."""
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if name:
        out.createOrReplaceTempView(name)
    return out


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Persistent table (S14, V16); bucketing co-locates later joins and point lookups on the key."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(name)


def sql(spark: SparkSession, text: str, args: Mapping | None = None) -> DataFrame:
    """SQL text with bound parameters."""
    return spark.sql(text, args=dict(args) if args else None)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(
    spark: SparkSession, name: str, columns: str, fmt: str = "parquet", location: str | None = None,
    options: Mapping[str, str] | None = None, clustered: tuple[Sequence[str], int] | None = None,
) -> None:
    """``CREATE TABLE ... USING fmt [OPTIONS] [CLUSTERED BY ... INTO n BUCKETS] [LOCATION]``."""
    opts = ""
    if options:
        opts = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    clu = ""
    if clustered:
        cols, n = clustered
        clu = f" CLUSTERED BY ({', '.join(cols)}) INTO {n} BUCKETS"
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{opts}{clu}{loc}")


def insert_rows(spark: SparkSession, name: str, rows: Sequence[Sequence]) -> None:
    """``INSERT INTO name VALUES (...)`` with NULLs (S18).  Values are bound as
    parameters (no string splicing) and cast to the column types by Spark."""
    rows = [tuple(r) for r in rows]
    if not rows:
        return
    width = len(rows[0])
    # named markers: positional ones inside a multi-row VALUES list bind out of order
    values = ", ".join(
        "(" + ", ".join(f":v{i * width + j}" for j in range(width)) + ")" for i in range(len(rows))
    )
    args = {f"v{i * width + j}": v for i, r in enumerate(rows) for j, v in enumerate(r)}
    spark.sql(f"INSERT INTO {name} VALUES {values}", args=args)

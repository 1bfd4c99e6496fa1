"""File sources and sinks.

Reads take explicit schemas where the format allows, so no inference pass
scans the data; writes are plain DataFrameWriter calls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# R readr column codes used by typed CSV reads
COL_CODES = {
    "c": T.StringType(),
    "i": T.IntegerType(),
    "d": T.DoubleType(),
    "n": T.DoubleType(),
    "l": T.BooleanType(),
    "D": T.DateType(),
    "T": T.TimestampType(),
}


def read_parquet(spark: SparkSession, path: str, name: str | None = None, cache: bool = False) -> DataFrame:
    """Parquet scan, optionally registered under ``name`` and cached."""
    df = spark.read.parquet(path)
    if cache:
        df = df.cache()
    if name:
        df.createOrReplaceTempView(name)
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    name: str | None = None,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV scan with a declared schema (S02, S05, S20); compressed files (.bz2,
    .gz) are read directly.  Without a schema the types are inferred, which
    costs an extra pass over the data."""
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote).option("mode", mode)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if name:
        df.createOrReplaceTempView(name)
    return df


def schema_from_codes(names: Sequence[str], codes: str) -> T.StructType:
    """``col_types = "ccccccii"`` to a StructType."""
    if len(names) != len(codes):
        raise ValueError("one code per column")
    return T.StructType([T.StructField(n, COL_CODES[c], True) for n, c in zip(names, codes)])


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, name: str | None = None) -> DataFrame:
    """JSON lines scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.json(path)
    if name:
        df.createOrReplaceTempView(name)
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    """Parquet sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV sink (S07)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines sink."""
    df.write.mode(mode).json(path)


def land_csv_as_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType | str,
    partition_by: Sequence[str] = (),
    header: bool = True,
) -> DataFrame:
    """Convert a CSV fact table to Parquet once, partitioned for pruning.

    Rows are gathered by the partition columns before the write so each task
    writes few files per partition value, and a value with many rows is split
    over several tasks by size; later year filters prune whole folders.
    """
    df = read_csv(spark, csv_path, schema, header=header)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    write_parquet(df, parquet_path, "overwrite", list(partition_by) or None)
    return spark.read.parquet(parquet_path)

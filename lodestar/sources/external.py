"""External tables over folders that grow: recovery of new partitions and statistics for planning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def external_table(
    spark: SparkSession, name: str, columns: str, location: str, fmt: str = "parquet", partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> DataFrame:
    """Table over the files in ``location``; dropping it leaves them.

    ``columns`` includes the partition columns.  For delimited text give
    ``fmt="csv"`` and options such as ``{"header": "true", "sep": "|"}``: the
    header line is skipped in every file (S19).  Partitions that are there
    already are recovered.
    """
    given = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")" if options else ""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}{given}{parts} LOCATION '{location}'")
    return recover(spark, name) if partition_by else spark.table(name)


def recover(spark: SparkSession, name: str) -> DataFrame:
    """Take in the partition folders added since (``ALTER TABLE .. RECOVER PARTITIONS``)."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> dict[str, str]:
    """Row count, size and, for ``columns``, distinct values, nulls and limits; returns the table's statistics line.

    Spark plans joins by these with ``spark.sql.cbo.enabled``; the size alone
    decides about a broadcast without it.
    """
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").collect()
    return {"statistics": rows[0]["data_type"] if rows else ""}


def column_statistics(spark: SparkSession, name: str, column: str) -> dict[str, str | None]:
    """min, max, num_nulls, distinct_count of an analysed column, as text."""
    found = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect()}
    return {k: None if found.get(k) == "NULL" else found.get(k) for k in ("min", "max", "num_nulls", "distinct_count")}

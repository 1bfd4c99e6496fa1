"""Yearly compressed CSV files landed as one partitioned Parquet table, again and again.

The year comes from a file's name.  Landing a year replaces what was landed of
it before and touches no other year.  Rows that do not fit the schema are not
dropped: they are written aside with their file and text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Landing:
    """The landed table and the rows set aside, both partitioned by year."""

    spark: SparkSession
    target: str
    aside: str
    schema: T.StructType
    year_col: str

    def rows(self) -> DataFrame:
        typed = T.StructType([*self.schema.fields, T.StructField(self.year_col, T.IntegerType())])
        return self.spark.read.schema(typed).parquet(self.target)

    def set_aside(self) -> DataFrame:
        """(file, record, year) of the rows that did not fit."""
        return self.spark.read.schema(f"file string, record string, `{self.year_col}` int").parquet(self.aside).where("record IS NOT NULL")

    def counts(self) -> DataFrame:
        """(year, n, n_aside) of every landed year, years without good rows included."""
        seen = self.spark.read.schema(f"file string, record string, `{self.year_col}` int").parquet(self.aside)
        aside = seen.groupBy(self.year_col).agg(F.count("record").alias("n_aside"))
        good = self.rows().groupBy(self.year_col).agg(F.count(F.lit(1)).alias("n"))
        return aside.join(good, self.year_col, "left").select(self.year_col, F.coalesce("n", F.lit(0)).alias("n"), "n_aside")


def _write(df: DataFrame, path: str, year_col: str) -> None:
    df.hint("rebalance", F.col(f"`{year_col}`")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year_col).parquet(path)


def land_years(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    schema: T.StructType | str,
    aside: str | None = None,
    year_pattern: str = r"(\d{4})[^/\d]*\.csv",
    year_col: str = "year",
    header: bool = True,
    sep: str = ",",
) -> Landing:
    """Land the CSV files under ``source`` (folders or files, plain, .bz2 or .gz) in ``target``, partitioned by year.

    ``year_pattern`` finds the year in a file's path (group 1); a file without
    one is an error, before anything is written.  Every year with a file in
    ``source`` is replaced, also by no rows at all.  ``schema`` is that of the
    files and has no year column.  The text is parsed once and written to the
    shared checkpoint folder, as good rows and rows set aside both come from it.
    """
    from lodestar.ml.features import training_table

    schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    aside = aside or f"{target.rstrip('/')}-aside"
    read = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(read).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT).option("recursiveFileLookup", True).csv(source)
    )
    files = spark.createDataFrame([(f,) for f in raw.inputFiles()], "file string")
    files = files.withColumn(year_col, F.regexp_extract("file", year_pattern, 1))
    nameless = files.where(F.col(year_col) == "").first()
    if nameless:
        raise ValueError(f"no year in the name of {nameless['file']}")
    files = files.withColumn(year_col, F.col(year_col).cast("int"))
    year = F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1).cast("int")
    parsed = training_table(raw.select(*[F.col(f"`{f.name}`") for f in read.fields], F.col("_metadata.file_path").alias("__file"), year.alias(year_col)))
    good, bad = parsed.where(F.col(_CORRUPT).isNull()), parsed.where(F.col(_CORRUPT).isNotNull())
    _write(good.drop(_CORRUPT, "__file"), target, year_col)
    # a row per file without a record keeps every landed year's partition current
    _write(bad.select(F.col("__file").alias("file"), F.col(_CORRUPT).alias("record"), year_col).unionByName(files.withColumn("record", F.lit(None).cast("string"))), aside, year_col)
    empty = files.select(year_col).distinct().join(good.select(year_col).distinct(), year_col, "left_anti")
    for r in empty.collect():  # years of which no row is left: at most one per year
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{year_col}={r[0]}")
    return Landing(spark, target, aside, schema, year_col)

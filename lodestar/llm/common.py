"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of repeating
    the work before it, and several readers share one computation.
    """
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def few(df: DataFrame, rows: int, per_task: int = 1 << 17) -> DataFrame:
    """``df``, known to have at most about ``rows`` short rows, in tasks of ``per_task`` rows, at least one for each core.

    For small tables of many passes: a pass then costs tasks by the rows it has,
    however many partitions the shuffles of the large tables are given.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go when the query ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *extra: str) -> DataFrame:
    """Only the named columns, null text as empty text."""
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(text_col, F.lit("")).alias(text_col), *extra)


def slices(batches: Iterable[pa.RecordBatch], text_col: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text, one row at least, to bound a worker's memory."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)

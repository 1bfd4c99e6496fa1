"""Life cycle of what a job writes: cached names, saved tables, checkpoint folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import checkpoint_dir
from lodestar.sources import catalog


class Workspace:
    """Owns tables, views, cache entries and files, and drops them when it is closed.

    >>> with Workspace(spark) as w:
    ...     trips = w.materialise(enriched, "trips")
    ...     w.cache("trips")
    ...     report = trips.groupBy("origin").count().collect()

    Results must be read or written elsewhere before it is closed.  Files lie
    in a folder of the shared checkpoint folder, so they survive a lost
    executor; several workspaces do not meet.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/workspace-{uuid.uuid4().hex}"
        self._views: list[str] = []
        self._tables: list[str] = []
        self._cached: list[str] = []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def materialise(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """Run the query once into the workspace's folder; readers see the written rows."""
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        return self.view(out, name) if name else out

    def view(self, df: DataFrame, name: str) -> DataFrame:
        df.createOrReplaceTempView(name)
        self._views.append(name)
        return self.spark.table(name)

    def cache(self, name: str) -> DataFrame:
        """Cache a table or view by name."""
        out = catalog.cache_table(self.spark, name)
        self._cached.append(name)
        return out

    def save(self, df: DataFrame, name: str, **options) -> DataFrame:
        """A persistent table that lives as long as the workspace; options as of ``catalog.save_table``."""
        catalog.save_table(df, name, **options)
        self._tables.append(name)
        return self.spark.table(name)

    def close(self) -> None:
        """Drop everything owned, in an order in which nothing is read any more; closing twice does nothing."""
        for name in reversed(self._cached):
            if self.spark.catalog.tableExists(name):
                self.spark.catalog.uncacheTable(name)
        for name in reversed(self._views):
            self.spark.catalog.dropTempView(name)
        for name in reversed(self._tables):
            catalog.drop_table(self.spark, name)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._views, self._tables, self._cached = [], [], []

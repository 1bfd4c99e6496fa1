"""Yearly landing, ORC buckets with decimals, external tables and the workspace."""

import bz2
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir
from lodestar.sources import catalog, external, landing
from lodestar.sources.workspace import Workspace

SCHEMA = "k long, day date, price double"


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    opened = bz2.open if name.endswith(".bz2") else open
    with opened(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(["k,day,price", *lines]) + "\n")


def state(done):
    rows = sorted((r.year, r.k, str(r.day), r.price) for r in done.rows().collect())
    return rows, sorted((r.year, r.record) for r in done.set_aside().collect()), sorted(tuple(r) for r in done.counts().collect())


def test_years_are_replaced_and_bad_rows_set_aside(spark, scratch_dir):
    target = f"{scratch_dir}/landed"
    put(f"{scratch_dir}/a", "2007.csv.bz2", "1,2007-01-02,1.5", "x,2007-01-03,2", "2,2007-02-30,2")
    put(f"{scratch_dir}/a", "2008.csv", "3,2008-05-05,", "4,2008-06-06,4,extra")
    first = state(landing.land_years(spark, f"{scratch_dir}/a", target, SCHEMA))
    assert first[0] == [(2007, 1, "2007-01-02", 1.5), (2008, 3, "2008-05-05", None)]
    assert first[1] == [(2007, "2,2007-02-30,2"), (2007, "x,2007-01-03,2"), (2008, "4,2008-06-06,4,extra")]
    assert first[2] == [(2007, 1, 2), (2008, 1, 1)]
    assert state(landing.land_years(spark, f"{scratch_dir}/a", target, SCHEMA)) == first  # twice is once
    put(f"{scratch_dir}/b", "2008.csv", "5,2008-07-07,5")
    again = state(landing.land_years(spark, f"{scratch_dir}/b", target, SCHEMA))
    assert again == ([first[0][0], (2008, 5, "2008-07-07", 5.0)], first[1][:2], [(2007, 1, 2), (2008, 1, 0)])
    put(f"{scratch_dir}/c", "2007.csv", "none,2007-01-01,1")
    emptied = state(landing.land_years(spark, f"{scratch_dir}/c", target, SCHEMA))
    assert emptied == ([again[0][1]], [(2007, "none,2007-01-01,1")], [(2007, 0, 1), (2008, 1, 0)])


def test_a_file_without_a_year_is_refused(spark, scratch_dir):
    put(f"{scratch_dir}/a", "trips.csv", "1,2007-01-02,1.5")
    with pytest.raises(ValueError, match="no year"):
        landing.land_years(spark, f"{scratch_dir}/a", f"{scratch_dir}/landed", SCHEMA)
    assert not os.path.exists(f"{scratch_dir}/landed")


def test_orc_buckets_prune_and_keep_decimals(spark):
    df = spark.range(200).select("id", (F.col("id") % 20).alias("key"), (F.col("id") / 100).cast("decimal(12,2)").alias("price"))
    with Workspace(spark) as w:
        t = w.save(df, "default.orc_prices", bucket_by=(8, ["key"]), sort_by=["key"], fmt="orc")
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # or the plan only says that no reader needs the buckets
        try:
            plan = t.where("key = 3")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        assert "SelectedBucketsCount: 1 out of 8" in plan and "orc" in plan.lower()
        total = t.groupBy("key").agg(F.sum("price").alias("total"))
        assert "Exchange" not in total._jdf.queryExecution().executedPlan().toString()
        assert t.agg(F.sum("price")).first()[0] == Decimal("199.00") and dict(t.dtypes)["price"] == "decimal(12,2)"
    assert not spark.catalog.tableExists("default.orc_prices")


def test_external_table_sees_recovered_folders_and_keeps_its_files(spark, scratch_dir):
    path = f"{scratch_dir}/t"
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("part"))
    df.where("part < 2").write.partitionBy("part").parquet(path)
    try:
        assert external.external_table(spark, "default.grows", "id long, part int", path, partition_by=["part"]).count() == 50
        df.where("part >= 2").write.mode("append").partitionBy("part").parquet(path)
        assert spark.table("default.grows").count() == 50
        assert external.recover(spark, "default.grows").count() == 100
        assert "100 rows" in external.analyze(spark, "default.grows", ["id"])["statistics"]
        assert external.column_statistics(spark, "default.grows", "id")["max"] == "99"
    finally:
        catalog.drop_table(spark, "default.grows")
    assert spark.read.parquet(path).count() == 100


def test_header_lines_are_skipped_in_every_file(spark, scratch_dir):
    for i in range(3):
        put(f"{scratch_dir}/d", f"f{i}.csv", f"{i},2001-01-01,1")
    try:
        t = external.external_table(spark, "default.lines", SCHEMA, f"{scratch_dir}/d", "csv", options={"header": "true", "sep": ","})
        assert sorted(r.k for r in t.collect()) == [0, 1, 2]
    finally:
        catalog.drop_table(spark, "default.lines")


def test_workspace_leaves_nothing(spark):
    shared = checkpoint_dir(spark).removeprefix("file:")
    before = {t.name for t in spark.catalog.listTables()}, set(os.listdir(shared)) if os.path.isdir(shared) else set()
    with Workspace(spark) as w:
        t = w.materialise(spark.range(10), "held")
        w.cache("held")
        w.save(t, "default.held_table")
        assert spark.catalog.isCached("held") and spark.table("default.held_table").count() == 10
        assert os.path.isdir(w.folder.removeprefix("file:"))
    w.close()
    assert ({t.name for t in spark.catalog.listTables()}, set(os.listdir(shared)) if os.path.isdir(shared) else set()) == before

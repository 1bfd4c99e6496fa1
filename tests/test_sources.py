"""Sources, sinks and catalog tasks on temporary folders."""

import os

from pyspark.sql import functions as F

from lodestar.sources import catalog, files
from tests.conftest import SF_SMALL


def test_parquet_register_and_cache(spark):
    df = files.read_parquet(spark, f"{SF_SMALL}/nation.parquet", name="nation_v", cache=True)
    assert catalog.table(spark, "nation_v").count() == df.count() == 25
    df.unpersist()


def test_csv_json_round_trip(spark, scratch_dir):
    src = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    csv_path, json_path = os.path.join(scratch_dir, "csv"), os.path.join(scratch_dir, "json")
    files.write_csv(src, csv_path)
    files.write_json(src, json_path)
    back = files.read_csv(spark, csv_path, src.schema)
    assert sorted(back.collect()) == sorted(src.collect())
    j = files.read_json(spark, json_path, src.schema)
    assert j.count() == src.count()


def test_typed_codes_and_compressed_csv(spark, scratch_dir):
    import bz2

    path = os.path.join(scratch_dir, "servers.csv.bz2")
    with bz2.open(path, "wt") as fh:
        fh.write("date,platform,flag,version,x,y,relays,z\n2016-01-01,Linux,Exit,0.2.7,a,b,10,3\n2016-01-02,,Guard,0.2.8,a,b,7,1\n")
    schema = files.schema_from_codes(["date", "platform", "flag", "version", "x", "y", "relays", "z"], "ccccccii")
    df = files.read_csv(spark, path, schema)
    assert df.agg(F.sum("relays")).first()[0] == 17
    assert df.where(F.col("platform").isNull()).count() == 1


def test_land_csv_as_parquet_partitioned(spark, scratch_dir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    csv_path, pq = os.path.join(scratch_dir, "o_csv"), os.path.join(scratch_dir, "o_pq")
    files.write_csv(src, csv_path)
    out = files.land_csv_as_parquet(spark, csv_path, pq, src.schema, partition_by=["year"])
    assert out.count() == src.count()
    assert any(name.startswith("year=") for name in os.listdir(pq))
    pruned = out.where(F.col("year") == 1996)
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text


def test_ddl_insert_and_buckets(spark):
    catalog.create_database(spark, "newdb")
    catalog.drop_table(spark, "newdb.pageviews")
    catalog.create_table(spark, "newdb.pageviews", "userid string, link string, came_from string")
    catalog.insert_rows(spark, "newdb.pageviews", [("jsmith", "mail.com", "sports.com"), ("jdoe", "mail.com", None)])
    pv = catalog.sql(spark, "SELECT * FROM newdb.pageviews WHERE link = :l", {"l": "mail.com"})
    assert pv.count() == 2 and pv.where(F.col("came_from").isNull()).count() == 1
    catalog.drop_table(spark, "newdb.students")
    catalog.create_table(spark, "newdb.students", "name string, age int, gpa decimal(3,2)", clustered=(["age"], 2))
    catalog.insert_rows(spark, "newdb.students", [("ann", 20, 3.5), ("bob", 21, None)])
    assert catalog.table(spark, "newdb.students").count() == 2


def test_save_table_bucketed_and_materialise(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    catalog.save_table(df, "orders_bucketed", bucket_by=(4, ["o_custkey"]), sort_by=["o_custkey"])
    t = catalog.table(spark, "orders_bucketed")
    assert t.count() == df.count()
    m = catalog.materialise(df.groupBy("o_orderstatus").count(), "status_counts")
    assert catalog.table(spark, "status_counts").count() == m.count() == 3


def test_upload_small_lookup(spark):
    df = catalog.upload(spark, [("AA", "American"), ("DL", "Delta")], "code string, description string", "airlines_v")
    assert catalog.table(spark, "airlines_v").count() == df.count() == 2


def test_external_csv_and_parquet_tables(spark, scratch_dir):
    """Tables declared over existing files, header line skipped, schema explicit."""
    csv_dir = os.path.join(scratch_dir, "airlines_csv")
    os.makedirs(csv_dir)
    with open(os.path.join(csv_dir, "part-0.csv"), "w") as fh:
        fh.write('Code,Description\n"AA","American Airlines Inc."\n"DL","Delta Air Lines, Inc."\n')
    catalog.drop_table(spark, "airlines_ext")
    catalog.create_table(
        spark, "airlines_ext", "Code string, Description string", fmt="csv",
        options={"header": "true", "quote": '"', "sep": ","}, location=csv_dir,
    )
    rows = {r["Code"]: r["Description"] for r in catalog.table(spark, "airlines_ext").collect()}
    assert rows == {"AA": "American Airlines Inc.", "DL": "Delta Air Lines, Inc."}

    pq_dir = os.path.join(scratch_dir, "nation_pq")
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.parquet(pq_dir)
    catalog.drop_table(spark, "nation_ext")
    catalog.create_table(spark, "nation_ext", "n_nationkey int, n_name string, n_regionkey int", location=pq_dir)
    assert catalog.table(spark, "nation_ext").count() == 25


def test_bucketed_tables_join_without_shuffle(spark):
    """Fact tables bucketed on the join key into the same number of buckets join
    without an exchange: the layout for repeated line-item / order joins at scale."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    catalog.save_table(li, "li_b", bucket_by=(8, ["l_orderkey"]), sort_by=["l_orderkey"])
    catalog.save_table(o, "o_b", bucket_by=(8, ["o_orderkey"]), sort_by=["o_orderkey"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = catalog.table(spark, "li_b").join(catalog.table(spark, "o_b"), F.col("l_orderkey") == F.col("o_orderkey"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_route_lookup_is_served_from_one_bucket(spark):
    from lodestar.plans import jobs
    from lodestar.plans import standins as si

    g = si.flights(spark, SF_SMALL).withColumn("gain", F.col("depdelay") - F.col("arrdelay")).withColumn("prediction", F.col("gain") * 0.5)
    g = g.withColumn("description", F.concat(F.lit("Carrier "), "uniquecarrier"))
    summary = jobs.route_summary(g)
    jobs.save_route_lookup(summary, "route_lookup", buckets=16)
    import io
    from contextlib import redirect_stdout

    # keep the bucketed scan on so the plan reports which buckets it reads
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        hit = jobs.serve_route(spark, "route_lookup", 3, 7)
        buf = io.StringIO()
        with redirect_stdout(buf):
            hit.explain("formatted")
        assert "SelectedBucketsCount: 1 out of 16" in buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    expected = summary.where((F.col("origin") == 3) & (F.col("dest") == 7)).count()
    assert hit.count() == expected


def test_ddl_query_leaves_no_database(spark):
    from lodestar.plans.catalogue import CATALOGUE
    from tests.conftest import SF_SMALL

    before = spark.sql("SHOW DATABASES").count()
    out = CATALOGUE["s18_ddl_insert"][0](spark, SF_SMALL)
    assert spark.sql("SHOW DATABASES").count() == before
    assert out.where("meaning = 'unknown'").select("n").collect() == [(0,)]

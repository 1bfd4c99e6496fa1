"""Properties of the distributed operators, checked against plain window forms."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.ml import evaluate
from lodestar.operators import rollups, verbs, visagg, windows


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 6)), min_size=0, max_size=60), st.integers(1, 5))
def test_top_k_equals_window_rank(spark, data, k):
    df = spark.createDataFrame(data, "g string, n long") if data else spark.createDataFrame([], "g string, n long")
    df = df.withColumn("id", F.monotonically_increasing_id())
    got = windows.top_k_with_ties(df, "n", k, by="g", salt_buckets=[1, 4][k % 2])
    ref = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.desc("n")))).where(F.col("rank") <= k)
    assert _rows(got, "id", "rank") == _rows(ref, "id", "rank")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=0, max_size=50), st.integers(1, 4))
def test_global_top_k_equals_window(spark, data, k):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id long, n long")
    got = windows.top_k_with_ties(df, "n", k)
    ref = df.withColumn("rank", F.rank().over(Window.orderBy(F.desc("n")))).where(F.col("rank") <= k)
    assert _rows(got, "id", "rank") == _rows(ref, "id", "rank")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 9))), max_size=60))
def test_rank_within_equals_window(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id long, g long, v long")
    got = windows.rank_within(df, "v", by="g")
    ref = df.withColumn(
        "rank", F.when(F.col("v").isNotNull(), F.rank().over(Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))))
    )
    assert _rows(got, "id", "rank") == _rows(ref, "id", "rank")


@pytest.mark.parametrize("n,tiles,parts", [(0, 10, 4), (7, 10, 3), (10, 10, 2), (15_000, 10, 8), (1001, 7, 5)])
def test_distributed_ntile_equals_window(spark, n, tiles, parts):
    df = spark.range(n).withColumn("score", (F.col("id") * 7919) % 101)
    order = [F.col("score").desc(), F.col("id").asc()]
    got = windows.ntile(df, tiles, order, "t", partitions=parts)
    ref = windows.ntile_window(df, tiles, order, "t")
    assert _rows(got, "id", "t") == _rows(ref, "id", "t")
    if n:
        sizes = [r[1] for r in got.groupBy("t").count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_cumulative_sum_distributed_path(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 13)
    got = windows.cumulative_sum(df, [F.col("id")], "v", "cum", partitions=6)
    ref = df.withColumn("cum", F.sum("v").over(Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)))
    assert _rows(got, "id", "cum") == _rows(ref, "id", "cum")


def test_histogram_properties(spark):
    df = spark.range(1000).select((F.col("id") % 97 * 1.5).alias("x"))
    h = visagg.histogram(df, "x", 30)
    rows = h.collect()
    assert len(rows) == 30 and sum(r["count"] for r in rows) == 1000
    assert [r["bin"] for r in sorted(rows)] == list(range(30))


def test_raster_sum_is_non_null_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, None), (2.0, 2.0), (3.0, 5.0)], "x double, y double")
    r = visagg.raster(df, "x", "y", 10)
    assert r.agg(F.sum("n")).first()[0] == 3
    assert r.agg(F.max("res_x"), F.max("res_y")).first() == (10, 10)


def test_lift_ends_at_one(spark):
    df = spark.range(200).select((F.col("id") % 17).cast("double").alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    lift = evaluate.lift_table(df, "s", "y").orderBy("bin").collect()
    assert len(lift) == 10 and abs(lift[-1]["prop"] - 1.0) < 1e-12


def test_hash_split_disjoint_and_covering(spark):
    df = spark.range(10_000)
    parts = verbs.hash_split(df, {"a": 0.7, "b": 0.2, "c": 0.1}, "id", seed=3)
    ids = [set(r[0] for r in p.collect()) for p in parts.values()]
    assert sum(len(s) for s in ids) == 10_000 and len(set().union(*ids)) == 10_000
    assert 6500 < len(ids[0]) < 7500


def test_pivot_unpivot_round_trip(spark):
    df = spark.createDataFrame([("d1", "a", 1.0), ("d1", "b", 2.0), ("d2", "a", 3.0)], "d string, k string, v double")
    wide = rollups.pivot_wide(df, "d", "k", ["a", "b"], F.sum("v"))
    long = rollups.unpivot_long(wide, "d", ["a", "b"], "k", "v").where(F.col("v").isNotNull())
    assert _rows(long, "d", "k", "v") == _rows(df, "d", "k", "v")


def test_auc_matches_spark_evaluator(spark):
    df = spark.range(3000).select(
        ((F.col("id") * 37) % 101).cast("double").alias("s"), (((F.col("id") * 11) % 7) < 3).cast("int").alias("y")
    )
    a = evaluate.auc(df, "s", "y").first()["auc"]
    b = evaluate.auc_evaluator(df, "s", "y")
    assert abs(a - b) < 1e-9


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-5, 40).map(lambda x: x / 4), st.just(4096.0))), max_size=80)
)
def test_distributed_percentiles_equal_builtin(spark, data):
    df = spark.createDataFrame(data, "g long, v double") if data else spark.createDataFrame([], "g long, v double")
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = rollups.percentile_table(df, "g", "v", probs)
    ref = df.groupBy("g").agg(*[F.percentile("v", p).alias(f"p{int(p * 100):02d}") for p in probs])
    a = {r["g"]: tuple(r)[1:] for r in got.collect()}
    b = {r["g"]: tuple(r)[1:] for r in ref.collect()}
    assert a.keys() == b.keys()
    for k in a:
        if b[k][0] is None:
            assert all(x is None for x in a[k])
        else:
            assert a[k] == pytest.approx(b[k], abs=1e-9)


def test_distributed_percentiles_skewed_group(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("g"),
        ((F.col("id") * 7919) % 997 / 10.0).alias("v"),
    )
    got = {r["g"]: tuple(r)[1:] for r in rollups.profile(df, "g", "v", method="distributed").collect()}
    ref = {r["g"]: tuple(r)[1:] for r in rollups.profile(df, "g", "v", method="exact").collect()}
    assert got.keys() == ref.keys()
    for k in got:
        assert got[k] == pytest.approx(ref[k], rel=1e-12)


def test_no_group_paths_have_no_cross_join(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 613 / 4.0).alias("v"), F.col("id"))
    got = rollups.profile(df, None, "v", method="distributed")
    ref = rollups.profile(df, None, "v", method="exact")
    assert tuple(got.first()) == pytest.approx(tuple(ref.first()), rel=1e-12)
    ranked = windows.rank_within(df, "v")
    wref = df.withColumn("rank", F.rank().over(Window.orderBy(F.desc("v"))))
    assert _rows(ranked, "id", "rank") == _rows(wref, "id", "rank")
    box = rollups.box_stats(df, None, "v").first()
    assert box["median"] == pytest.approx(ref.first()["p50"])
    for out in (got, ranked, box_df := rollups.box_stats(df, None, "v")):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, text


def test_distributed_profile_counts_null_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    got = {r["g"]: r for r in rollups.profile(df, "g", "v", method="distributed").collect()}
    ref = {r["g"]: r for r in rollups.profile(df, "g", "v", method="exact").collect()}
    assert got["a"]["n"] == ref["a"]["n"] == 3 and got["b"]["n"] == ref["b"]["n"] == 1
    assert got["a"]["mean"] == ref["a"]["mean"] == 2.0 and got["b"]["mean"] is None
    assert got["a"]["p50"] == ref["a"]["p50"] == 2.0 and got["b"]["p50"] is None


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_grouped_ntile_equals_window(spark, parts):
    df = spark.range(2500).select(
        F.when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        ((F.col("id") * 37) % 11).alias("s"),
        "id",
    )
    order = [F.col("s").desc(), F.col("id").asc()]
    got = windows.ntile(df, 7, order, "t", partitions=parts, by="g")
    ref = windows.ntile_window(df, 7, order, "t", by="g")
    assert _rows(got, "id", "t") == _rows(ref, "id", "t")


def test_materialized_histogram_equals_lazy(spark):
    df = spark.range(3000).select(((F.col("id") * 13) % 211 / 3.0).alias("x"), ((F.col("id") * 7) % 97 / 2.0).alias("y"))
    a = visagg.histogram(df, "x", 17, materialize=True).collect()
    b = visagg.histogram(df, "x", 17).collect()
    assert sorted(a) == sorted(b)
    r1 = visagg.raster(df, "x", "y", 40, materialize=True).collect()
    r2 = visagg.raster(df, "x", "y", 40).collect()
    assert sorted(r1) == sorted(r2)

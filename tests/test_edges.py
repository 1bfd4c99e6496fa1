"""Hand-made edge fixtures (FIXTURES.md section 4)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lodestar.functions import scalar as fx
from lodestar.ml.features import bucketize
from lodestar.operators import geo, joins, rollups, verbs, visagg, windows


@pytest.fixture()
def nulls(spark):
    return spark.createDataFrame(
        [(1, 1.0, 2.0), (2, None, 3.0), (3, 4.0, None), (4, None, None), (5, float("nan"), 1.0), (6, 2.0, 2.0)],
        "k int, x double, y double",
    )


def test_null_rows_are_skipped(spark, nulls):
    # NaN counts as missing, as R's is.na(NaN) is TRUE
    assert verbs.drop_missing(nulls, ["x", "y"]).count() == 2
    m = rollups.summarize(nulls.where(~F.isnan("x") | F.col("x").isNull()), None, {"m": F.avg("x")}).first()["m"]
    assert m == pytest.approx(7.0 / 3)
    h = visagg.histogram(nulls.where(~F.isnan("x") | F.col("x").isNull()), "x", 5).collect()
    assert sum(r["count"] for r in h) == 3


def test_rank_ties_at_cut(spark):
    df = spark.createDataFrame(
        [("a", 5), ("a", 4), ("a", 4), ("a", 4), ("a", 1), ("b", 2), ("b", 2), ("b", 2), ("c", 9)], "g string, n long"
    )
    got = windows.top_k_with_ties(df, "n", 2, by="g").groupBy("g").count()
    assert dict(got.collect()) == {"a": 4, "b": 3, "c": 1}
    ext = windows.extremes(df, "n", by="g").groupBy("g").count()
    assert dict(ext.collect()) == {"a": 2, "b": 3, "c": 1}


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0, 3.0)] * 5, "x double, y double")
    h = visagg.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [5, 0, 0, 0] and h[0]["bin_floor"] == 3.0
    assert visagg.raster(df, "x", "y", 10).first()["n"] == 5
    sd = rollups.summarize(df.limit(1), None, {"sd": F.stddev_samp("x")}).first()["sd"]
    assert sd is None


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert visagg.histogram(df, "x", 3).agg(F.sum("count")).first()[0] == 0
    assert windows.top_k_with_ties(df, "x", 3, by="g").count() == 0
    assert windows.ntile(df, 10, [F.col("x")], "t").count() == 0


def test_one_row_group(spark):
    df = spark.createDataFrame([("a", 2.0)], "g string, x double")
    b = rollups.box_stats(df, "g", "x").first()
    assert b["q1"] == b["median"] == b["q3"] == 2.0 and b["n_outliers"] == 0
    p = rollups.profile(df, "g", "x").first()
    assert p["p10"] == p["p90"] == 2.0


def test_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 2.0, 5.0, 12.0, 13.0, None]], "x double")
    inside = df.where("x IS NULL OR (x >= 1 AND x <= 12)")
    out = bucketize(inside, "x", [1.0, 2.0, 5.0, 12.0], "b", handle_invalid="keep").collect()
    got = {r["x"]: r["b"] for r in out}
    assert got[1.0] == 0 and got[2.0] == 1 and got[5.0] == 2 and got[12.0] == 2
    assert got[None] is None  # NULL passes through; NaN would go to the extra bucket; out of range raises
    left = df.select("x", verbs.bucket_closed_left("x", [1.0, 2.0, 5.0, 12.0]).alias("b")).collect()
    assert {r["x"]: r["b"] for r in left} == {0.0: None, 1.0: 0.0, 2.0: 1.0, 5.0: 2.0, 12.0: 2.0, 13.0: None, None: None}
    right = df.select("x", verbs.bucket_closed_right("x", [1.0, 2.0, 5.0, 12.0]).alias("b")).collect()
    assert {r["x"]: r["b"] for r in right} == {0.0: None, 1.0: None, 2.0: 0.0, 5.0: 1.0, 12.0: 2.0, 13.0: None, None: None}
    with pytest.raises(Exception):
        bucketize(df.where("x = 13"), "x", [1.0, 2.0, 5.0, 12.0], "b", handle_invalid="error").collect()


def test_duplicate_lookup_key(spark):
    fact = spark.createDataFrame([(1,), (2,)], "gid int")
    lookup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "gid int, name string")
    with pytest.raises(ValueError):
        joins.role_join(fact, lookup, "gid", {"p": "gid"}, {"name": "name"}, check_unique=True)
    assert joins.role_join(fact, lookup, "gid", {"p": "gid"}, {"name": "name"}).count() == 3


def test_dirty_codes(spark):
    df = spark.createDataFrame([(" CSH",), ("Cash",), ("1",), ("CRD",), ("zzz",), (None,)], "c string")
    dom = {"cash": ["csh", "cash", "2"], "credit": ["crd", "credit", "1"]}
    got = [r[0] for r in df.select(verbs.normalise_codes("c", dom)).collect()]
    assert got == ["cash", "cash", "credit", "credit", "unk", "unk"]


def test_negative_and_half_values(spark):
    df = spark.createDataFrame([(-2.5,), (-0.5,), (0.5,), (2.5,)], "x double")
    got = [r[0] for r in df.select(F.round("x", 0)).collect()]
    assert got == [-3.0, -1.0, 1.0, 3.0]
    m = spark.range(1).select((F.lit(-7) % 3).alias("sql"), fx.r_mod(F.lit(-7), F.lit(3)).alias("r"), F.pmod(F.lit(-7), F.lit(3)).alias("p")).first()
    assert (m["sql"], m["r"], m["p"]) == (-1, 2, 2)
    half = spark.range(1).select(fx.round_half_up(F.lit(2.5), 0).alias("a"), fx.round_half_up(F.lit(0.125), 2).alias("b")).first()
    assert half["a"] == 3 and half["b"] == pytest.approx(0.13)


def test_year_ends_and_rounding(spark):
    ts = [dt.datetime(2015, 12, 31, 23, 59, 59, 900000), dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 3, 10, 29, 59), dt.datetime(2016, 1, 4, 10, 30)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    out = df.select(F.weekofyear("ts").alias("w"), F.year("ts").alias("y"), fx.round_to_hour("ts").alias("h"), fx.epoch_seconds("ts").alias("e")).collect()
    assert [r["w"] for r in out] == [53, 53, 53, 1]
    assert out[0]["h"] == dt.datetime(2016, 1, 1, 0, 0) and out[2]["h"] == dt.datetime(2016, 1, 3, 10) and out[3]["h"] == dt.datetime(2016, 1, 4, 11)
    assert out[1]["e"] == 1451606400 and out[0]["e"] == 1451606399


def test_great_circle_edge_points(spark):
    df = spark.createDataFrame(
        [("same", 10.0, 20.0, 10.0, 20.0), ("dateline", 0.0, 170.0, 0.0, -170.0), ("quarter", 0.0, 0.0, 0.0, 90.0)],
        "r string, lat1 double, lon1 double, lat2 double, lon2 double",
    )
    pts = geo.great_circle_points(df, 3)
    rows = {(r["r"], r["step"]): (r["lat"], r["lon"]) for r in pts.collect()}
    assert rows[("same", 2)] == pytest.approx((10.0, 20.0))
    assert rows[("quarter", 2)] == pytest.approx((0.0, 45.0), abs=1e-9)
    mid = rows[("dateline", 2)]
    assert abs(abs(mid[1]) - 180.0) < 1e-6 and abs(mid[0]) < 1e-9
    assert rows[("quarter", 4)] == pytest.approx((0.0, 90.0))


def test_case_insensitive_names(spark):
    df = spark.createDataFrame([(1, 2)], "SibSp int, Parch int").withColumn("Family_Size", F.col("SibSp") + F.col("Parch") + 1)
    assert df.select("family_size").first()[0] == 4


def test_dotted_names(spark, scratch_dir):
    import os

    from lodestar.sources import files

    path = os.path.join(scratch_dir, "iris.csv")
    with open(path, "w") as fh:
        fh.write('"Sepal.Length","Sepal.Width","Petal.Length","Petal.Width","Species"\n5.1,3.5,1.4,0.2,"setosa"\n7.0,3.2,4.7,1.4,"versicolor"\n')
    schema = files.schema_from_codes(["Sepal.Length", "Sepal.Width", "Petal.Length", "Petal.Width", "Species"], "ddddc")
    df = files.read_csv(spark, path, schema)
    assert df.select(F.max("`Sepal.Length`")).first()[0] == 7.0


def test_pairwise_t_small(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 6.0), ("c", 0.0), ("c", 1.0)], "g string, v double")
    t = {(r["group_a"], r["group_b"]): r["t"] for r in rollups.pairwise_t(df, "g", "v").collect()}
    # pooled variance = (2*1 + 1*2 + 1*0.5) / 4 = 1.125
    assert t[("a", "b")] == pytest.approx((2.0 - 5.0) / math.sqrt(1.125 * (1 / 3 + 1 / 2)))


def test_t_p_values_known_points():
    import numpy as np

    from lodestar.functions.distributions import regularized_beta, t_two_sided_p_values

    # t = 2.228 with 10 df is the 97.5 % quantile; t = 1.96 with huge df ~ normal
    p = t_two_sided_p_values(np.array([2.228138851986, 1.959963984540, 0.0]), np.array([10.0, 1e7, 5.0]))
    assert p[0] == pytest.approx(0.05, abs=1e-9) and p[1] == pytest.approx(0.05, abs=1e-6) and p[2] == pytest.approx(1.0)
    assert regularized_beta(np.array([0.3]), np.array([2.0]), np.array([3.0]))[0] == pytest.approx(0.3483, abs=1e-4)


def test_pairwise_t_tests_holm(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 6.0), ("c", 0.0), ("c", 1.0)], "g string, v double")
    rows = rollups.pairwise_t_tests(df, "g", "v").collect()
    ps = sorted(r["p_value"] for r in rows)
    holm = sorted(r["p_holm"] for r in rows)
    assert len(rows) == 3 and all(0 <= p <= 1 for p in ps)
    assert holm[0] == pytest.approx(min(1.0, 3 * ps[0]))


def test_small_weights_get_their_rows(spark):
    df = spark.range(400_000)
    parts = verbs.hash_split(df, {"most": 0.9999, "few": 0.0001}, "id")
    few = parts["few"].count()
    assert 10 <= few <= 80 and few + parts["most"].count() == 400_000
    assert verbs.hash_split(df, {"a": 1, "none": 0}, "id")["none"].count() == 0


def test_brush_with_open_sides(spark):
    df = spark.createDataFrame([(x, y) for x in range(5) for y in range(5)], "x int, y int")
    assert verbs.brush(df, "x", "y").count() == 25
    assert verbs.brush(df, "x", "y", xmin=3).count() == 10
    assert verbs.brush(df, "x", "y", xmin=1, xmax=2, ymax=0).count() == 2


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(-2.5,), (2.5,), (-0.5,), (0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(fx.round_half_up("x")).collect()] == [-3, 3, -1, 1, None]


def test_rank_of_dates_and_texts_with_a_null_group(spark):
    rows = [("a", "x", "2020-01-02"), ("a", "y", "2020-01-01"), (None, "x", "2020-01-03"), (None, "z", "2020-01-03"), (None, "q", None)]
    df = spark.createDataFrame(rows, "g string, t string, d string").withColumn("d", F.col("d").cast("date"))
    got = {(r.g, r.t): r["rank"] for r in windows.rank_within(df, "d", "g").collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, (None, "x"): 1, (None, "z"): 1, (None, "q"): None}
    got = {(r.g, r.t): r["rank"] for r in windows.rank_within(df, "t", "g", descending=False).collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, (None, "q"): 1, (None, "x"): 2, (None, "z"): 3}


def test_an_outlier_does_not_gather_the_rest(spark):
    """200,000 values and one far off: no range partition of the numbering has more than a quarter."""
    df = spark.range(200_000).select(F.when(F.col("id") == 7, 1e15).otherwise(F.rand(3)).alias("v"), F.lit(1).alias("c"))
    ranged = df.repartitionByRange(16, "v").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in ranged) < 50_000
    got = {r["__ahead"] for r in windows.ahead_counts(df, [], "v", "c").where("v > 1e14").collect()}
    assert got == {0}

"""Plan checks: broadcast lookups, pruned scans, pushed filters, no Python on the row path,
no single-partition window over raw rows."""

import pytest

from lodestar.plans.catalogue import CATALOGUE
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(k for k, (_, s) in CATALOGUE.items() if s is not None))
def test_no_python_udf_on_row_path(spark, key):
    fn, _ = CATALOGUE[key]
    text = formatted(fn(spark, SF_SMALL))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_role_join_broadcasts_lookup(spark):
    fn, _ = CATALOGUE["j02_role_join"]
    text = formatted(fn(spark, SF_SMALL))
    assert text.count("BroadcastHashJoin") >= 2


def test_scan_is_pruned_and_filter_pushed(spark):
    fn, _ = CATALOGUE["p12_ranges"]
    text = formatted(fn(spark, SF_SMALL))
    # lineitem read with only the needed columns, delay range pushed into the scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert "GreaterThan(l_quantity,15.0)" in text and "LessThan(l_quantity,40.0)" in text


def test_top_k_has_no_single_partition_over_rows(spark):
    fn, _ = CATALOGUE["w01_topk_ties"]
    text = formatted(fn(spark, SF_SMALL))
    # each map task ships at most k rows (plus ties) before the shuffle
    assert "Partial" in text and "WindowGroupLimit" in text


def test_ntile_uses_range_partitions(spark):
    from pyspark.sql import functions as F

    from lodestar.operators import windows

    df = spark.range(1000).withColumn("s", F.col("id") % 7)
    out = windows.ntile(df, 10, [F.col("s").desc(), F.col("id")], "t", partitions=4)
    text = formatted(out)
    assert "Window [ntile" not in text
    assert out.count() == 1000


def test_scalar_limits_are_merged_into_one_scan(spark):
    fn, _ = CATALOGUE["v02_raster"]
    text = formatted(fn(spark, SF_SMALL))
    assert "mergedValue" in text  # min/max of both axes come from one subquery
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_k_salts_above_the_group_limit_threshold(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lodestar.operators import windows

    df = spark.range(3000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7) % 101).alias("v"), "id")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = windows.top_k_with_ties(df, "v", 10, by="g")
        assert "__salt" in formatted(got)
        ref = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))).where("rank <= 10")
        assert sorted(got.select("id", "rank").collect()) == sorted(ref.select("id", "rank").collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")

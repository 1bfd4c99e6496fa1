"""The joined input of a model that reads its rows several times is computed once."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lodestar.ml import models, search
from lodestar.plans import jobs
from lodestar.plans.catalogue import CATALOGUE


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small lineitem, part, supplier, orders and customer tables, with repeated and missing keys."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1997, 1, 1)
    made = {
        "lineitem": (
            [(i % 40, i % 30, i % 7, i % 5, float(i % 50 + 1), 10.0 * i, 0.01 * (i % 9), 0.02, "ANR"[i % 3], day + dt.timedelta(days=7 * (i % 200))) for i in range(900)] + [(None, 1, 1, 1, 5.0, 1.0, 0.0, 0.0, "A", day)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
        ),
        "part": ([(i, f"Brand#{i % 4}", (7 * i) % 50 + 1, 900.0 + 13 * i % 101) for i in range(29)], "p_partkey long, p_brand string, p_size int, p_retailprice double"),
        "supplier": ([(i, i % 3) for i in range(7)], "s_suppkey long, s_nationkey int"),
        "orders": ([(i % 38, i % 11, "O", day + dt.timedelta(hours=31 * i), "2-HIGH") for i in range(44)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(i, i % 2 if i % 5 else None) for i in range(10)], "c_custkey long, c_nationkey int"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


@pytest.mark.parametrize("key", ["m20_residual_hist", "m21_out_of_time", "m22_glm_gaussian", "m28_grid_search", "m31_model_comparison"])
def test_models_do_not_repeat_the_join(spark, tables, monkeypatch, key):
    seen = []

    def watched(of, name):
        real = getattr(of, name)

        def run(df, *args, **kwargs):
            seen.append(df._jdf.queryExecution().optimizedPlan().toString())
            return real(df, *args, **kwargs)

        monkeypatch.setattr(of, name, run)

    watched(models, "fit_regressor")
    watched(search, "grid_search")
    rows = CATALOGUE[key][0](spark, tables).collect()
    assert rows and seen
    assert not any("Join" in plan for plan in seen)


def test_quartiles_of_trips_come_from_narrow_rows(spark):
    """The percentiles are not taken beside the seventeen measures, and count each trip time as often as it occurs."""
    start = dt.datetime(1997, 1, 1)
    rows = [(1, 2 if i % 4 else None, start, start + dt.timedelta(seconds=60 * (i % 5)) if i % 6 else None, float(i)) for i in range(60)]
    trips = spark.createDataFrame(rows, "pickup_gid int, dropoff_gid int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, fare_amount double")
    zeros = ("trip_distance", "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", "passenger_count", "tip_amount")
    trips = trips.withColumns({c: F.lit(0.0) for c in zeros} | {"cab_type_id": F.lit("A")})
    out = jobs.od_rollups(trips)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("percentile(" in line and "avg(" in line for line in plan.splitlines())
    found = {r["grain"]: r for r in out.collect()}
    assert set(found) == {"od_hour", "od", "origin"}
    for grain, r in found.items():
        times = sorted(60.0 * (i % 5) for i in range(60) if i % 6 and (grain == "origin" or i % 4))
        assert r["n"] == (60 if grain == "origin" else 45)
        for p in (25, 50, 75):
            at = (len(times) - 1) * p / 100
            low, high = times[int(at)], times[-int(-at // 1)]
            assert r[f"trip_time_p{p}"] == pytest.approx(low + (high - low) * (at - int(at)))

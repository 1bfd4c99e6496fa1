"""Successive halving against the full grid."""

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from lodestar.ml import search
from lodestar.operators import sampling


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(6000).withColumn("a", (F.col("id") % 97).cast("double")).withColumn("b", (F.col("id") % 13).cast("double"))
    return df.withColumn("y", F.when(F.col("a") > 50, F.col("b") * 3).otherwise(F.col("a")) + F.sin("id"))


def test_halving_finds_the_winner_of_the_full_grid(data):
    grid = {"maxDepth": [1, 2, 4, 7], "minInstancesPerNode": [1, 800]}
    tree = DecisionTreeRegressor(seed=1)
    found = search.halving_search(data, "id", "y ~ a + b", tree, grid, factor=2).collect()
    valid = sampling.row_hash("id") < round(0.2 * 2**60)
    full = search.grid_search(data.where(~valid), data.where(valid), "y ~ a + b", tree, grid).collect()
    assert [r["rank"] for r in found] == list(range(1, 9))
    assert found[0].params == full[0].params and found[0].mse == pytest.approx(full[0].mse, rel=1e-9)
    assert sorted(r["round"] for r in found) == [1, 1, 1, 1, 2, 2, 3, 4] and found[0].share == 1.0


def test_random_subset_is_seeded_and_single_models_take_one_round(data):
    grid = {"regParam": [0.0, 0.1, 1.0, 10.0], "elasticNetParam": [0.0, 0.5]}
    runs = [search.halving_search(data, "id", "y ~ a", LinearRegression(), grid, max_models=3, seed=5).collect() for _ in range(2)]
    assert [r.params for r in runs[0]] == [r.params for r in runs[1]] and len(runs[0]) == 3
    one = search.halving_search(data, "id", "y ~ a", LinearRegression(), {"regParam": [0.5]}).collect()
    assert len(one) == 1 and one[0]["round"] == 1 and one[0].share == 1.0

"""Portable samples and exact splits."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lodestar.operators import sampling, verbs


def plain_hash(seed, *key):
    text = "|".join([str(seed), *["\\N" if k is None else str(k) for k in key]])
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_hash_is_the_first_digits_of_md5(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "é|b")], "k long, s string")
    for r in df.withColumn("h", sampling.row_hash(["k", "s"], 9)).collect():
        assert r.h == plain_hash(9, r.k, r.s)


@pytest.mark.parametrize("n", [0, 1, 7, 999, 1000, 1500])
def test_sample_takes_the_smallest_hashes(spark, n):
    df = spark.range(1000).repartition(4)
    want = sorted(range(1000), key=lambda i: plain_hash(42, i))[:n]
    assert sorted(r.id for r in sampling.sample_exact(df, n, "id").collect()) == sorted(want)
    assert verbs.sample_exact(df, n, 42, ["id"]).count() == min(n, 1000)


def test_refinement_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_STEP_BITS", 5)
    df = spark.range(3000)
    want = sorted(plain_hash(1, i) for i in range(3000))
    got = sampling._refined(df.select(sampling.row_hash("id", 1).alias("__h")), [1, 2, 1234, 2999, 3000])
    assert got == {r: (want[r - 1], r - 1, 1) for r in (1, 2, 1234, 2999, 3000)}


def test_sizes_are_exact_when_a_third_of_the_rows_are_alike(spark):
    df = spark.createDataFrame([(i if i % 3 else 0, "x") for i in range(3000)], "k long, s string").repartition(5)
    for cut in (1, 400, 1300, 2999):
        parts = sampling.split_by_sizes(df, {"a": cut, "b": 3000 - cut, "none": 5})
        assert [parts[p].count() for p in ("a", "b", "none")] == [cut, 3000 - cut, 0]
        assert parts["a"].unionByName(parts["b"]).groupBy("k").count().where("k = 0").first()["count"] == 1000
        again = sampling.split_by_sizes(df.repartition(3), {"a": cut}, seed=42)["a"]
        assert again.exceptAll(parts["a"]).isEmpty()


def test_weights_columns_and_odd_tables(spark):
    df = spark.createDataFrame([(i, {"m": i}, f"t{i}") for i in range(101)], "id long, `a.b` map<string,int>, __x string")
    parts = sampling.split_by_weights(df, {"train": 0.7, "test": 0.3}, "id")
    assert (parts["train"].count(), parts["test"].count()) == (71, 30)
    assert parts["train"].columns == df.columns
    ids = {r.id for p in parts.values() for r in p.select("id").collect()}
    assert ids == set(range(101))
    assert all(p.count() == 0 for p in sampling.split_by_weights(df.where("id < 0"), {"a": 1, "b": 1}, "id").values())
    with pytest.raises(ValueError, match="negative"):
        sampling.split_by_sizes(df, {"a": -1}, "id")


def test_bernoulli_and_folds(spark):
    df = spark.range(20_000)
    kept = {r.id for r in sampling.hash_sample(df, 0.1, "id", 5).collect()}
    assert kept == {i for i in range(20_000) if plain_hash(5, i) < round(0.1 * 2**60)} and 1800 < len(kept) < 2200
    folds = {r.id: r.f for r in df.select("id", sampling.fold_of("id", 3, 5).alias("f")).where(F.col("id") < 50).collect()}
    assert folds == {i: plain_hash(5, i) % 3 for i in range(50)}

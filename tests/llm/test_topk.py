"""Top-k against all inner products."""

import math
import random

import numpy as np
import pytest

from lodestar.llm import topk


def brute_force(rows, k, every):
    usable = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        query = min(v for i, v in usable if i == q)
        hits = sorted((-sum(a * b for a, b in zip(query, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(query))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return out


@pytest.mark.parametrize("shard_rows,block_rows", [(8192, 1024), (37, 5)])
def test_equals_brute_force_with_ties_and_unusable_rows(spark, shard_rows, block_rows):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5, -0.25, 0.125, 0.0, 1.0, -1.0]) for i in range(300, 420)]  # one vector again and again
    rows += [(500, None), (550, []), (600, [float("nan")] * 6), (650, [float("inf")] + [0.0] * 5), (700, [None] + [0.0] * 5), (750, [1.0, 2.0]), (751, [3.0, 4.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(5)
    got = topk.top_k(df, k=5, query_every=50, shard_rows=shard_rows, block_rows=block_rows).collect()
    assert sorted(tuple(r) for r in got) == brute_force(rows, 5, 50)


def test_empty_and_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, schema)).collect()] == [(0, 1, 1, 256 * 128)]


def test_tree_prunes_nothing_it_needs():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-300, 300, (500, 4)).astype(float)
    tree = topk.Tree(np.arange(500), vectors, leaf=8)
    queries = rng.integers(-300, 300, (20, 4)).astype(float)
    for i, ids, scores in tree.search(np.full(20, -1), queries, np.full(20, -(2**60)), 7):
        every = vectors @ queries[i]
        assert ids.tolist() == np.lexsort((np.arange(500), -every))[:7].tolist() and (scores == every[ids]).all()

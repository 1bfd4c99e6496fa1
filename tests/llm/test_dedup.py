"""Near-duplicates against a comparison of all pairs."""

import random

import numpy as np
import pytest

from lodestar.llm import dedup
from lodestar.llm.components import components
from tests.llm.helpers import SCHEMA, empty_docs, odd_docs


def brute_force(rows, width, percent):
    """{doc_id: (size, component)} by comparing every pair."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        shingles = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
        sets[i] = shingles
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def copies(seed: int = 3, n: int = 260):
    """Families of near copies with all rates of change, chains of small changes, copies of one large group."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 40, 150]))]
        for _ in range(rng.choice([1, 2, 6, 25])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 8))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                base = text  # a chain: each copy is changed again
            rows.append((i * 7 % 1009, " ".join(text)))
            i += 1
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_links_equal_brute_force(spark, width):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in dedup.link(docs, width, 80).collect()}
    assert got == brute_force(rows, width, 80)


@pytest.mark.parametrize("block", [1, 7])
def test_the_last_steps_meet_all_pairs(spark, monkeypatch, block):
    """With pivots that say little and small blocks, the rest falls to families and blocks."""
    monkeypatch.setattr(dedup, "PIVOT_ROUNDS", 1)
    monkeypatch.setattr(dedup, "_order", lambda turn: -dedup.F.col("rep"))
    monkeypatch.setattr(dedup, "BLOCK", block)
    rows = copies(8, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in dedup.link(docs, 2, 80).collect()}
    assert got == {i: c for i, (_, c) in brute_force(rows, 2, 80).items()}


def test_odd_rows(spark):
    out = dedup.link(odd_docs(spark), 2, 80)
    rows = out.collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs(spark).count()
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[0].n_shingles == by_id[1].n_shingles == 0 and by_id[0].component_id == 0 and by_id[1].component_id == 1
    assert by_id[5].component_id == 4 and not by_id[5].kept  # one, One
    assert by_id[8].component_id == 7 and by_id[10].component_id == 9
    assert dedup.link(empty_docs(spark)).count() == 0
    assert dedup.link(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 1


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    docs = odd_docs(spark)
    kept = dedup.drop_near_duplicates(docs, 2, 80)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [0, 1, 2, 3, 4, 6, 7, 9, 11, 12]
    assert kept.where("doc_id is null").count() == 1
    assert spark.createDataFrame([], SCHEMA).count() == dedup.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(60)] + [(3, 3), (None, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e if None not in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_missed_pairs_are_as_rare_as_said():
    """At a similarity of 0.8 the chunks miss fewer than one pair in 100,000, by simulation of the chunks."""
    rng = np.random.default_rng(0)
    equal = rng.random((200_000, dedup.CHUNKS, dedup.CHUNK)) < 0.8
    met = (equal.sum(2) >= dedup.CHUNK - dedup.ERRORS).any(1)
    assert (~met).mean() < 2e-5
    assert (equal.sum((1, 2)) < dedup.LEAST_EQUAL).mean() < 2e-5


def test_small_tables_take_few_tasks(spark):
    """However many partitions shuffles are given, rounds over few edges and steps over few keys are few tasks."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    cores = spark.sparkContext.defaultParallelism
    many = 12 * cores
    edges = spark.createDataFrame([(i, i + 1 + i % 3) for i in range(900)], "a long, b long")
    docs = spark.createDataFrame(copies(5, 60), "doc_id long, text string")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", many)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert len(components(edges).inputFiles()) <= cores
        spark.sparkContext.setJobGroup("few-tasks", "")
        dedup.link(docs, 2, 80)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("few-tasks")]
    stages = {s for j in jobs if j for s in j.stageIds}
    infos = [i for i in map(tracker.getStageInfo, stages) if i and i.numCompletedTasks]
    assert sum(i.numTasks >= many for i in infos) <= len(infos) // 5

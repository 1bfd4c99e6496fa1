"""The pipeline against its stages by brute force on a small table."""

import random

import corpus_pipeline
from lodestar.llm import packing, quality, secrets
from lodestar.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import brute_force


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = stages[0](spark, docs, SF_SMALL)
    assert good.columns == columns
    kept = {r.doc_id for r in quality.classify(docs, labels).collect() if r.keep}
    assert {r.doc_id for r in good.collect()} == kept
    clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert len(clean & kept) >= 0.97 * len(clean)
    alone = stages[1](spark, good, SF_SMALL)
    assert alone.columns == columns
    expected = brute_force([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert {r.doc_id for r in alone.collect()} == {i for i, (_, c) in expected.items() if c == i}
    masked = stages[2](spark, alone, SF_SMALL)
    before = {r.doc_id: r.text for r in alone.collect()}
    for r in masked.collect():
        assert r.text == secrets.redact(before[r.doc_id])
    final = corpus_pipeline.run(spark, SF_SMALL).collect()
    words = {r.doc_id: len(r.text.encode().lower().split()) + 1 for r in masked.collect()}
    packed: dict = {}
    for r in final:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_tokens
    assert packed == words
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in ORACLE_SQL


def test_every_number_has_a_query():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_packing_is_the_same_for_any_order(spark):
    rows = [(i, " ".join("w" for _ in range(random.Random(i).randint(0, 90))), f"s{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    a = packing.pack_documents(docs.repartition(7), capacity=100).collect()
    b = packing.pack_documents(docs.coalesce(1), capacity=100).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))

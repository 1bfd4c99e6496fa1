"""Quality classifier: held-out accuracy on the given labels, and odd rows."""

import zlib

import numpy as np

from lodestar.llm import quality
from tests.llm.helpers import empty_docs, odd_docs


SF_LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    held = {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 0}
    known = labels.where(~labels["doc_id"].isin(list(held)))
    got = {r.doc_id: r.keep for r in quality.classify(docs, known).collect()}
    assert len(got) == docs.count()
    good = [got[i] for i in held if rows[i] == (1, 0)]
    poor = [got[i] for i in held if rows[i][0] == 0]
    toxic = [got[i] for i in held if rows[i] == (1, 1)]
    assert np.mean(good) > 0.97 and np.mean(poor) < 0.05 and np.mean(toxic) < 0.2


def test_fit_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 600)
    rows = [np.unique(np.concatenate([[g], rng.integers(10, 60, 8)])).astype(np.int32) for g in grades]
    weights, cuts = quality.fit(rows, grades, 64)
    assert cuts[0] < cuts[1] and weights[0] < weights[1] < weights[2]


def test_odd_rows_and_ratings(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (7, 1, None), (None, 1, 0), (9, 1, 0), (11, 1, 1)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id, r.grade) for r in quality.graded(labels).collect()} == {(4, 0), (9, 2), (11, 1)}
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.expected_grade <= 2 and r.keep is not None for r in rows)
    unrated = quality.classify(docs, labels.where("false")).collect()
    assert all(r.keep and r.tail is None for r in unrated) and len(unrated) == docs.count()
    assert quality.keep_good(docs, labels.where("false")).count() == docs.count()
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.classify(empty_docs(spark), labels).count() == 0

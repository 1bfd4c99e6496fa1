"""Fingerprints: edited texts and order by brute force, likeness against exact similarity."""

import hashlib

import pandas as pd
import pytest

from lodestar.llm import fingerprint
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs


def expected_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((doc_id, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_bucket", [1, 3, 2000])
def test_edited_texts(spark, monkeypatch, per_bucket):
    docs = odd_docs(spark)
    whole = fingerprint.with_next
    monkeypatch.setattr(fingerprint, "with_next", lambda *a, **k: whole(*a, **k, per_bucket=per_bucket))
    got = fingerprint.fingerprints(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == expected_edits([(r.doc_id, r.text) for r in docs.collect()])


def test_single_rows_nulls_and_none(spark):
    one = fingerprint.fingerprints(spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c a b c").hexdigest()[:0] + hashlib.sha256(("a b c d e f"[:6] + "a b c"[:5]).encode()).hexdigest()
    nulls = fingerprint.fingerprints(spark.createDataFrame([(None, "x y"), (None, None)], "doc_id long, text string")).collect()
    assert len(nulls) == 2 and {r.fingerprint == "" for r in nulls} == {True, False}
    assert fingerprint.fingerprints(empty_docs(spark)).count() == 0


def test_equal_texts_have_equal_fingerprints_and_likeness_is_near_the_truth(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    frame = pd.DataFrame({"text": [t for _, t in rows], "print": [got[i].fingerprint for i, _ in rows]})
    assert (frame.groupby("text")["print"].nunique() == 1).all()

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    errors = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        for other, found in ((text[: len(text) - half] + after[:half], got[doc_id].near_edited), (after, got[doc_id].near_next)):
            a, b = shingles(text), shingles(other)
            assert 0 <= found <= 1
            errors.append(found - len(a & b) / max(1, len(a | b)))
    errors = pd.Series(errors)
    assert abs(errors.mean()) < 0.02 and errors.abs().mean() < 0.05


def test_no_python_in_the_plan(spark):
    plan = fingerprint.fingerprints(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning(_bucket") <= 4

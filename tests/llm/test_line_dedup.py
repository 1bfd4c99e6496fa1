"""Line deduplication against a dictionary version."""

import hashlib
from collections import defaultdict

import pytest

from lodestar.llm import line_dedup
from tests.llm.helpers import empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(rows, min_docs, min_chars, keep_first=False):
    holders, first = defaultdict(set), {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < min_chars or len(holders[key(line)]) < min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in frame.collect()), key=str)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


TEXTS = [
    "Header\nbody one\n  header \n\nÉcole",
    "header\t\nbody two\nécole\n\n",
    "\n\n",
    "École\nHEADER\nbody one\n\x0bheader\x0c",
    "\n".join(f"line {i % 97}" for i in range(1000)),
    "\n".join(f"line {i % 89}" for i in range(700)),
    "x" * 300_000 + "\nheader",
    "  header ",  # white space outside ASCII stays
]


@pytest.mark.parametrize("hot_keys", [1, 50, 1000])
@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (2, 1), (2, 0), (3, 7), (10, 1)])
def test_against_dictionaries(spark, monkeypatch, hot_keys, min_docs, min_chars):
    monkeypatch.setattr(line_dedup, "HOT_KEYS", hot_keys)
    docs = odd_docs(spark, [None, "", *TEXTS], extra=[(2, "another text\nheader", "", "", 1, None, None, None, None), (None, "header\nno id", "", "", 1, None, None, None, None)])
    got = line_dedup.line_dedup(docs, min_docs, min_chars)
    assert found(got) == expected(pairs(docs), min_docs, min_chars)


@pytest.mark.parametrize("hot_keys", [1, 1000])
def test_first_occurrence_stays(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(line_dedup, "HOT_KEYS", hot_keys)
    docs = spark.createDataFrame([(3, "a\nb\na"), (1, "b\nc\nB"), (2, "A\nd")], "doc_id long, text string")
    got = line_dedup.line_dedup(docs, min_docs=2, keep_first=True)
    assert found(got) == [(1, 3, 1, "b\nc"), (2, 2, 0, "A\nd"), (3, 3, 3, "")]


def test_digests_bitmaps_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "same\n" * 130 + f"own {i}") for i in range(12)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.digests(docs).collect()}
    assert got[4].n_lines == 131 and got[4].n_dropped == 130 and got[4].kept_sha256 == hashlib.sha256(b"own 4").hexdigest()
    bitmap = line_dedup.drop_bitmaps(docs).first()
    assert [(e.word, e.bits & (2**64 - 1)) for e in bitmap.dropped] == [(0, 2**64 - 1), (1, 2**64 - 1), (2, 3)]
    assert line_dedup.digests(empty_docs(spark)).count() == 0


def test_plan_is_native_and_sorts_hash_ranges_once(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    lines = line_dedup.line_hashes(line_dedup._base(docs, "doc_id", "text"), 1)
    plan = line_dedup.dropped_lines(lines, 10, False)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and plan.count("hashpartitioning(h1#") <= 2
    whole = line_dedup.digests(docs)._jdf.queryExecution().toString()
    assert "Python" not in whole and "Arrow" not in whole and "CartesianProduct" not in whole

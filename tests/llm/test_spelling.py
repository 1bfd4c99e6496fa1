"""Spelling variants against all pairs."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lodestar.llm import spelling
from lodestar.llm.fm_index import FMIndex, suffix_array
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return short in deletions(long)


def expected_words(rows, slip):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def expected(counts):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= 2 * counts[w]:
                form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def found(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_suffix_array_orders_prefixes():
    rng = np.random.default_rng(1)
    for size, depth in ((1, 1), (7, 3), (300, 40), (300, 400)):
        codes = rng.integers(0, 3, size)
        order = suffix_array(codes, depth)
        shown = [tuple(codes[i : i + depth]) for i in order]
        assert shown == sorted(shown) and sorted(order) == list(range(size))
    assert suffix_array(np.ones(500, np.int64), 500)[0] == 499


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_index_finds_all_pairs(letters):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(400)})
    table = {c: i + 1 for i, c in enumerate(letters)}
    coded = [np.array([table[c] for c in w]) for w in words]
    index = FMIndex(coded, len(letters))
    exact = np.array([len(w) - len(w) // 2 for w in words])
    q, w = index.one_error(coded, exact)
    got = {(words[a], words[b]) for a, b in zip(q, w)}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b) and b.endswith(a[len(a) // 2 :])}


@pytest.mark.parametrize("shard_chars", [60, 2000, 400_000])
def test_variants_of_a_dense_vocabulary(spark, monkeypatch, shard_chars):
    monkeypatch.setattr(spelling, "SHARD_CHARS", shard_chars)
    rng = random.Random(4)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(5, 8))) for _ in range(300)} | {"étéàÉ", "etéàÉ", "étéàé", "w" * 400, "w" * 401, "w" * 399 + "x"}
    counts = {w: rng.choice([3, 4, 7, 9, 20, 80, 400]) for w in sorted(words)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert found(spelling.variants(vocab)) == expected(counts)


@pytest.mark.parametrize("slip", [None, 7, 97])
def test_words_of_texts(spark, slip):
    rng = random.Random(6)
    stems = ["réseau", "Houses", "house", "mouse", "größe", "l'état", "x×y÷z", "Ünder", "under", "a", "naïveté", "İstanbul", "Ÿber", "ſtone"]
    texts = [" ".join(rng.choice(stems) for _ in range(200)) for _ in range(12)] + [None, "", "12 !?"]
    docs = odd_docs(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    counts = expected_words(rows, slip)
    got = Counter(r.word for r in spelling.words(docs, slip).collect())
    assert got == counts
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert found(spelling.group_spellings(docs, slip)) == expected(kept)


def test_corpus_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = expected_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 97)
    want = expected({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    got = found(spelling.group_spellings(docs, 97))
    assert got == want and any(r[1] for r in want)
    assert spelling.group_spellings(empty_docs(spark), 97).count() == 0
    assert spelling.group_spellings(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0


def test_factor_must_not_allow_circles(spark):
    with pytest.raises(ValueError, match="factor"):
        spelling.variants(spark.createDataFrame([("words", 3)], "word string, n long"), factor=1)

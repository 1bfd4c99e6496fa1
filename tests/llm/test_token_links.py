"""Cross-tokenizer alignment against the libraries over whole texts and dictionaries."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lodestar.llm import token_links
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def bytes_of_chars():
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    out, n = {}, 0
    for b in range(256):
        if b in shown:
            out[chr(b)] = b
        else:
            out[chr(256 + n)], n = b, n + 1
    return out


def groups_of(libraries, text):
    """[(A ids, B ids)] by walking over the bytes of whole texts; none if a side does not give the text back."""
    a, b = libraries
    if not text:
        return []
    table = bytes_of_chars()
    enc = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(table[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return []
    ends = [set(), set()]
    for k, side in enumerate((left, right)):
        at = 0
        for _, x in side:
            at += len(x)
            ends[k].add(at)
    cuts, out = sorted(ends[0] & ends[1]), []
    at = [0, 0]
    pos = [0, 0]
    for cut in cuts:
        group = []
        for k, side in enumerate((left, right)):
            ids = []
            while pos[k] < cut:
                ids.append(side[at[k]][0])
                pos[k] += len(side[at[k]][1])
                at[k] += 1
            group.append(ids)
        out.append(group)
    return out


def expected(libraries, rows):
    groups = [groups_of(libraries, text) for _, text in rows]
    links = [Counter((x, y) for g, h in doc for x in g for y in h) for doc in groups]
    held = Counter(pair for doc in links for pair in doc)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), doc, linked in zip(rows, groups, links):
        shown = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in doc)
        out.append((
            doc_id, sum(len(g) for g, _ in doc), sum(len(h) for _, h in doc), len(doc), sum(linked.values()),
            sum(n for p, n in linked.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in linked.items()),
            hashlib.sha256(shown.encode()).hexdigest() if doc else "",
        ))
    return sorted(out, key=str), held, best


def found(frame):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=str)


def odd_texts():
    rng = random.Random(3)
    signs = ["a", "B", " ", "  ", "\n", "\t", "　", " ", " ", "é", "ß", "я", "漢字", "🎉", "́", "₿", "'s", "'", "12", "…", "\x00", "\x1f", "​", "<s>", "<|endoftext|>", "x" * 70, "ΑΒ", "\u0085", "­"]
    mixed = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    long = " ".join(rng.choice(["und", "the", "мир", "où", "été", "naïve", "tschüß", "a1b2", "c'est", "“x”", "—", "日本"]) for _ in range(20_000))
    return [" lead", "trail ", "▁mark", "mark▁ inside", " ", "\n", "é x", "é é я я 漢 漢 字", "a" * 5000, "é" * 3000, "漢" * 2000, *mixed, long]


@pytest.mark.parametrize("block,held", [(8 << 20, 300_000), (300, 300_000), (2000, 50)])
def test_against_whole_texts(spark, monkeypatch, libraries, block, held):
    monkeypatch.setattr(token_links, "BLOCK_BYTES", block)
    monkeypatch.setattr(token_links.Aligner, "MOST_HELD", held)
    extra = [(100 + i, t, None, None, None, None, None, None, None) for i, t in enumerate(odd_texts())]
    docs = odd_docs(spark, extra=extra)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, held, best = expected(libraries, rows)
    assert found(token_links.align(docs, A, B)) == want
    assert sum(r[3] > 0 for r in want) > 100 and sum(r[3] == 0 for r in want) > 3
    if block > 300:
        counts = {(r.a, r.b): (r["count"], r.best) for r in token_links.pair_counts(docs, A, B).collect()}
        assert counts == {p: (n, n == best[p[0]]) for p, n in held.items()}


def test_corpus(spark, libraries):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(token_links.align(docs.repartition(5), A, B)) == expected(libraries, rows)[0]


def test_empty_tables(spark):
    assert token_links.align(empty_docs(spark), A, B).count() == 0
    only_empty = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert found(token_links.align(only_empty, A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_large_groups_are_counted_by_distinct_ids(spark, monkeypatch, libraries):
    text = "it's 漢字漢字 e\u0301te\u0301 " * 3 + "a" * 300
    want = expected(libraries, [(1, text)])[0]
    for limit in (0, 1, 3, 4096):
        monkeypatch.setattr(token_links, "LARGE_GROUP", limit)
        assert found(token_links.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B)) == want


def test_decoded_bytes_refine_spans():
    import numpy as np

    # the second token begins inside the first one's character: its end is that of the decoded bytes
    assert token_links.token_ends(np.array([3, 6, 6]), np.array([False, False, True]), np.array([2, 5, 6])).tolist() == [2, 5, 6]


def test_known_model_is_asked_for_ids_alone(libraries):
    """A model that keeps its text gives the same alignment by ids as by the spans of its protos, at less cost."""
    with open(A, "rb") as a, open(B, "rb") as b:
        spec, model = a.read(), b.read()
    fragments = [" word", " ", " é€😀", " \tab\n", " 日本語テキスト", " \x00😀x", " a  b ▁c", " \U0001f9eázz", " <s></s>"]
    by_ids, by_spans = token_links.Aligner(spec, model), token_links.Aligner(spec, model)
    assert by_ids.cuttable
    by_spans.cuttable = False

    class Ids:
        def __init__(self, of):
            self.of, self.asked = of, []

        def encode(self, texts, **how):
            self.asked.append(how.get("return_type"))
            return self.of.encode(texts, **how)

    by_ids.b = Ids(by_ids.b)
    x, y = by_ids.add(fragments), by_spans.add(fragments)
    assert set(by_ids.b.asked) == {int}
    assert x.groups == y.groups
    for name in ("whole", "figures", "first", "pair", "times"):
        assert getattr(x, name).tolist() == getattr(y, name).tolist()

"""Token counts and byte-level BPE against their libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lodestar.llm import byte_bpe, token_counts
from tests.llm.helpers import empty_docs, odd_docs

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANKS_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "aàéßΣσςİıK'’srtvemldRE l  \n\t.!?,-_0123²½Ⅷ漢あ🎉👍🏽é́̇  \u0085\x1c\x0b"


def random_texts(n: int) -> list[str]:
    rng = random.Random(11)
    texts = []
    for i in range(n):
        kind = i % 5
        if kind == 0:
            texts.append("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))))
        elif kind == 1:
            texts.append("".join(rng.choice("'srevmltd \n") for _ in range(rng.randint(0, 25))))
        elif kind == 2:
            texts.append("".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(20)))
        elif kind == 3:
            texts.append("".join(rng.choice(["<|endoftext|>", "<|", "a", " ", "endoftext|>", "Hello", "\t \n"]) for _ in range(8)))
        else:
            texts.append("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 500))))
    return [*texts, "", " ", "a" * 4000, "ab" * 2000, "'" * 700, "1" * 500, " " * 900, "漢字" * 500]


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(RANKS_FILE)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe.Codec(ranks)


def test_counts_equal_the_library():
    texts = random_texts(3000)
    with open(WORD_FILE, encoding="utf-8") as f:
        counter = token_counts.TextCounter(f.read())
    expected = [len(e.ids) for e in Tokenizer.from_file(WORD_FILE).encode_batch(texts, add_special_tokens=False)]
    assert counter(texts).tolist() == expected


def test_chunk_borders_do_not_matter(monkeypatch):
    text = "we'll don't 're l've\n'ell 12'd " * 50
    classes = token_counts.code_point_classes()[np.array([ord(c) for c in text + " "])]
    whole = token_counts.word_starts(classes)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        assert (token_counts.word_starts(classes) == whole).all()


def test_states_can_be_dropped(monkeypatch):
    with open(WORD_FILE, encoding="utf-8") as f:
        counter = token_counts.TextCounter(f.read())
    monkeypatch.setattr(token_counts.WordTransducer, "MOST_STATES", 10)
    library = Tokenizer.from_file(WORD_FILE)
    for word in ("transducer", "antidisestablishment", "zzzzzzzzqqq"):
        assert counter.words.count(word.encode()) == len(library.encode(word, add_special_tokens=False).ids)


def test_count_rows(spark):
    library = Tokenizer.from_file(WORD_FILE)
    docs = odd_docs(spark)
    got = sorted(token_counts.count_tokens(docs, WORD_FILE).collect(), key=str)
    expected = []
    for r in docs.collect():
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        expected.append((r.doc_id, len(text.encode()), n, n > 2048))
    assert [tuple(r) for r in got] == sorted(expected, key=lambda r: str(dict(zip(("doc_id", "n_bytes", "n_tokens", "over_limit"), r, strict=True)))) or sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert token_counts.count_tokens(empty_docs(spark), WORD_FILE).count() == 0


def test_encode_equals_the_library(reference):
    library, codec = reference
    texts = random_texts(1500)
    ids, bounds = codec.encode(texts)
    decoded = codec.decode(ids, bounds)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode_ordinary(text), text
        assert decoded[i] == text.encode()


def test_small_windows_agree(reference, monkeypatch):
    library, codec = reference
    rng = random.Random(2)
    monkeypatch.setattr(byte_bpe.Codec, "WINDOW", 80)
    for text in ("".join(rng.choice("etaoins") for _ in range(3000)), "abc" * 900, "q" * 1000):
        (tokens,) = codec._windowed([text.encode()])
        assert tokens.tolist() == library.encode_ordinary(text)


def test_digest_rows(spark, reference):
    library, _ = reference
    docs = odd_docs(spark)
    got = sorted((tuple(r) for r in byte_bpe.digests(docs, RANKS_FILE).collect()), key=str)
    expected = []
    for r in docs.collect():
        text = r.text or ""
        ids = library.encode_ordinary(text)
        expected.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(expected, key=str)
    assert byte_bpe.digests(empty_docs(spark), RANKS_FILE).count() == 0
    row = byte_bpe.encode_decode(docs, RANKS_FILE).where("doc_id = 7").first()
    assert row.ids == library.encode_ordinary("a b c d e f g") and bytes(row.decoded) == b"a b c d e f g"

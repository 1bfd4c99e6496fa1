"""Words that polynomial hashes modulo a power of two confuse: a Thue-Morse word and its complement."""

import base64

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from lodestar.llm import byte_bpe, dedup, suffix_tree, token_counts
from lodestar.llm.shingles import span_hashes, word_hashes


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


PAIRS = [(thue_morse(n, ab), thue_morse(n, ab[::-1])) for n in (512, 1024, 2048, 4096) for ab in ("ab", "tz")]
TEXTS = [w for pair in PAIRS for w in pair]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)


def test_hashes_differ_and_do_not_depend_on_the_place():
    hashes, _ = word_hashes(pa.array([" ".join(TEXTS), *TEXTS]))
    assert len(set(hashes.tolist())) == len(TEXTS)
    symbols = np.array([5, 1, 2, 3, 9, 1, 2, 3, 1, 2], np.uint64)
    got = span_hashes(symbols, np.array([1, 5, 8]), np.array([4, 8, 10]))
    assert got[0] == got[1] != got[2]


def test_token_counts(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(TEXTS)}


def test_byte_bpe(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in byte_bpe.encode_decode(docs, path).collect()}
    assert got == {i: (own.encode_ordinary(x), x.encode()) for i, x in enumerate(TEXTS)}


def test_sets_are_not_alike(docs):
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in dedup.link(docs, width=2, percent=80).collect()}
    assert got == {i: (i, 1) for i in range(len(TEXTS))}


def test_counts_of_words_in_training(docs):
    got = suffix_tree.score(docs, depth=None, support=2).collect()
    trained = [r for r in got if not r.held_out]
    assert all(r.n_known == 2 for r in trained) and all(r.n_known == 1 for r in got if r.held_out)

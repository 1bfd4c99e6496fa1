"""Packing: nothing lost, no conflict, and best fit against a search of all bins."""

import random
from collections import defaultdict

from lodestar.llm import packing
from lodestar.llm.queries import op8_best_fit_packing
from tests.llm.helpers import empty_docs, odd_docs


def brute_force(pieces, capacity):
    bins, placed = [], []
    for size, source, cluster in pieces:
        fits = [(capacity - b["used"], i) for i, b in enumerate(bins) if capacity - b["used"] >= size and source not in b["sources"] and cluster not in b["clusters"]]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "sources": set(), "clusters": set(), "n": 0})
        placed.append((i, bins[i]["n"]))
        bins[i]["used"] += size
        bins[i]["n"] += 1
        bins[i]["sources"].add(source)
        bins[i]["clusters"].add(cluster)
    return placed


def test_pack_equals_a_search_of_all_bins():
    rng = random.Random(9)
    for _ in range(40):
        pieces = sorted(((rng.randint(1, 50), rng.choice([0, 0, 0, 1, 2, 3]), rng.randint(0, 30)) for _ in range(120)), reverse=True)
        assert packing.pack(pieces, 50) == brute_force(pieces, 50)


def test_every_token_is_packed_once_without_conflict(spark):
    texts = [None, "", "a b", "A  b\n", *(" ".join(f"w{j}" for j in range(i * 13 % 97)) for i in range(150)), " ".join("long" for _ in range(1000))]
    docs = odd_docs(spark, texts)
    rows = packing.pack_documents(docs, capacity=64, shard_pieces=60).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
        pieces[r.doc_id].append(r)
    for held in bins.values():
        assert sum(r.n_tokens for r in held) == held[0].bin_tokens <= 64
        assert sorted(r.slot for r in held) == list(range(len(held)))
        named = [source[r.doc_id] for r in held if source[r.doc_id] is not None]
        assert len(named) == len(set(named))
        assert len({(texts[r.doc_id] or str(r.doc_id)).lower().split().__str__() if r.doc_id is not None else "none" for r in held}) == len(held) or any(not (texts[r.doc_id] or "").split() for r in held if r.doc_id is not None)
    last = len(texts) - 1
    for doc_id, held in pieces.items():
        copies = 2 if doc_id == last else 1
        text = "no id at all here" if doc_id is None else texts[doc_id] or ""
        assert sum(r.n_tokens for r in held) == copies * (len(text.split()) + 1)
    assert packing.pack_documents(empty_docs(spark)).count() == 0


def test_near_copies_and_texts_without_blanks(spark, scratch_dir):
    rng = random.Random(8)
    words = [rng.choice("abcdefghij") + rng.choice("klmnopqrst") for _ in range(200)]
    near = [" ".join(words[:i] + [f"changed{i}"] + words[i + 1 :]) for i in range(0, 120, 10)]
    texts = [*near, near[3], "", None, "漢字仮名" * 3000]
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)] + [(None, near[5], "none"), (None, near[5], "none either")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{scratch_dir}/documents.parquet")
    out = op8_best_fit_packing(spark, scratch_dir).collect()
    copies = [r.bin_id for r in out if r.doc_id is None or r.doc_id < 13]
    assert len(copies) == 15 and len(set(copies)) == 15
    cut = [r for r in out if r.doc_id == 15]
    assert len(cut) > 1 and max(r.n_tokens for r in cut) == 2048
    assert [r.start_token for r in sorted(cut, key=lambda r: r.piece)] == [2048 * i for i in range(len(cut))]
    assert [r.n_tokens for r in out if r.doc_id in (13, 14)] == [1, 1]

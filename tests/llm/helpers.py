"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, label long, rep string, key string"


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "don't", "we'll", "x1", "été", "漢字", "...", "🎉"]
    long = " ".join(rng.choice(words) for _ in range(6000))
    return [None, "", " ", "\n\t ", "one", "One", "two words", "a b c d e f g", "a b c d e f g", long, long + " end", "Σίσυφος ΣΑΣ <|endoftext|> 's 're", "ab" * 3000]


def odd_docs(spark, texts=None, extra=()):
    """Rows with null ids, repeated rows, equal texts, clashing names of extra columns."""
    texts = odd_texts() if texts is None else texts
    rows = [(i, t, "en", "s" if i % 2 else None, len(t) if t is not None else None, False, 1, "r", "k") for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "no id at all here", None, None, 17, None, None, None, None), *extra]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)

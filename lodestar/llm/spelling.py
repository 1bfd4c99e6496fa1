"""Spelling variants: words of a corpus one edit apart, by FM-index search schemes over sharded vocabularies.

Two words one edit apart agree in the first half of either or in its second
half (the one the edit is not in).  Each search of the scheme matches one half
exactly, starting at its delimiter, and extends over the other with one error:
to the right for the first half, to the left for the second.  A vocabulary is
dealt to shards by those halves, of all lengths that a word one edit longer or
shorter would match, so a word meets all its near words in the shard of its own
half, and a shard holds an FM-index of its words read in the search's
direction.  A half that fills more than a shard is split into a grid of parts
of the words to search and of the words searched for.

Nothing is emitted per pair: a search returns the number of a word's near words
and the most frequent one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import shared_table
from lodestar.llm.fm_index import FMIndex

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARD_CHARS = 400_000
_STATE_CHARS = 16_000  # letters of the words searched for at a time
_FOUND = "word string, n_near long, best_n long, best string"


def words(docs: DataFrame, slip: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every run of Latin letters, one row each, A-Z lower-cased; a null text has none.

    With ``slip``, a run whose CRC-32 of ``<id>:<run>`` it divides loses the
    letter at that number modulo its length.  A null id is written as nothing.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit("[A-Za-z\\u00C0-\\u00FF]+"), F.lit(0))).alias("run"))
    lowered = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    runs = runs.select("id", lowered.alias("word"))
    if slip is None:
        return runs.select("word")
    runs = runs.select("word", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("word")).cast("int")
    slipped = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return runs.select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("word")).alias("word"))


def vocabulary(found: DataFrame, min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the words of ``min_chars`` code points that occur ``min_count`` times."""
    return found.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _halves() -> Column:
    """The halves a word is searched at (its own, query) and found at (also those of words one letter longer or shorter)."""
    n = F.length("word")

    def half(first: bool, of: Column, query: bool) -> Column:
        size = F.floor(of / 2).cast("int")
        key = F.substring("word", F.lit(1), size) if first else F.right("word", size)
        return F.struct(F.lit(first).alias("first"), key.alias("half"), F.lit(query).alias("query"))

    own = [half(True, n, True), half(False, n + 1, True)]
    # one of n - 1 and n + 1 has the half of n, which is also the own one
    other = [half(True, F.when(n % 2 == 0, n - 1).otherwise(n + 1), False), half(False, F.when(n % 2 == 0, n + 2).otherwise(n), False)]
    return F.array(*own, *other)


def _dealt(vocab: DataFrame) -> DataFrame:
    """(shard, first, word, n, query, target): the words to search and to be found in each shard."""
    rows = vocab.select("word", "n", F.explode(_halves()).alias("h")).select("word", "n", "h.*")
    chars = vocab.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    shards = max(1, -(-4 * chars // SHARD_CHARS))
    weight = F.sum(F.length("word") + 1)
    heavy = rows.groupBy("first", "half").agg(F.ceil(weight / SHARD_CHARS).cast("int").alias("parts")).where("parts > 1")
    rows = rows.join(F.broadcast(heavy), ["first", "half"], "left")  # at most 4 * chars / SHARD_CHARS rows
    parts, mine = F.coalesce("parts", F.lit(1)), F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), parts - 1)

    def place(i: Column, j: Column, query: Column, target: Column) -> Column:
        return F.struct(F.xxhash64("first", "half", i, j).alias("shard"), query.alias("query"), target.alias("target"))

    no, yes = F.lit(False), F.lit(True)
    light = F.array(F.struct(F.pmod(F.xxhash64("first", "half"), F.lit(shards)).alias("shard"), F.col("query"), yes.alias("target")))
    found = F.transform(every, lambda j: place(mine, j, no, yes))
    searched = F.when(F.col("query"), F.transform(every, lambda i: place(i, mine, yes, no)))
    grid = F.concat(found, F.coalesce(searched, F.array().cast("array<struct<shard:bigint,query:boolean,target:boolean>>")))
    rows = rows.select("first", "word", "n", F.explode(F.when(F.col("parts").isNull(), light).otherwise(grid)).alias("at"))
    return rows.select("first", "word", "n", "at.*")


def _codes(words: list[str], letters: np.ndarray, backwards: bool) -> list[np.ndarray]:
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    codes = np.searchsorted(letters, points) + 1
    parts = np.split(codes, np.cumsum([len(w) for w in words])[:-1])
    return [p[::-1] for p in parts] if backwards else parts


def _batches(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, size in enumerate(lengths.tolist()):
        if i > start and held + size > _STATE_CHARS:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(lengths):
        yield start, len(lengths)


def search_shard(group: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, best_n, best) of the words searched in a shard that have near words in it."""
    first = bool(group["first"].iloc[0])
    targets = group[group["target"]].drop_duplicates("word").sort_values(["n", "word"], ascending=[False, True])
    queries = group.loc[group["query"], "word"].drop_duplicates().tolist()
    out: list[tuple] = []
    if len(targets) and queries:
        names, counts = targets["word"].tolist(), targets["n"].tolist()
        letters = np.unique(np.frombuffer("".join(names + queries).encode("utf-32-le"), np.uint32))
        index = FMIndex(_codes(names, letters, first), len(letters))
        coded = _codes(queries, letters, first)
        lengths = np.array([len(q) for q in queries])
        exact = lengths // 2 if first else lengths - lengths // 2
        for a, b in _batches(lengths):
            q, w = index.one_error(coded[a:b], exact[a:b])
            if not first:  # those with the same first half are found by the other search
                other = [not names[y].startswith(queries[a + x][: lengths[a + x] // 2]) for x, y in zip(q.tolist(), w.tolist(), strict=True)]
                q, w = q[other], w[other]
            found, at, times = np.unique(q, return_index=True, return_counts=True)
            best = w[at].tolist()  # targets stand in order of frequency, pairs in order of targets
            out += [(queries[a + x], n, counts[y], names[y]) for x, n, y in zip(found.tolist(), times.tolist(), best, strict=True)]
    return pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``vocab`` (word, n) that have words one edit apart.

    ``best`` is the near word of largest n, the smallest in code-point order
    among equals.  Words are distinct and have two letters at least.
    """
    found = _dealt(vocab).groupBy("shard", "first").applyInPandas(search_shard, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the last word reached by following forms, which never return.

    Each round doubles the steps taken; frequencies at least double with each
    form, so a chain is no longer than the logarithm of the largest.
    """
    at = shared_table(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = shared_table(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(vocab: DataFrame, factor: int = 2) -> DataFrame:
    """One row per row of ``vocab`` (word, n): word, form, root, n, n_near, form_n.

    Near words are one inserted, deleted or replaced code point apart.  A
    word's form is its near word of largest n (ties: smallest in code-point
    order) if that n is ``factor`` times its own at least (2 or more); its root
    is the end of the chain of forms, the word itself if it has none.  An empty
    vocabulary gives no rows.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could return")
    vocab = shared_table(vocab.select("word", "n"), "spelling-vocabulary")
    accepted = F.col("best_n") >= factor * F.col("n")
    rows = vocab.join(near_words(vocab), "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(accepted, F.col("best")).alias("form"),
        F.when(accepted, F.col("best_n")).alias("form_n"),
    )
    rows = shared_table(rows, "spelling-forms")
    ends = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, slip: int | None = None, min_chars: int = 5, min_count: int = 3, factor: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`variants` of the words of all whole texts.

    Null and empty texts have no words; repeated rows count each; without
    words there are no rows; other columns are not read.
    """
    return variants(vocabulary(words(docs, slip, id_col, text_col), min_chars, min_count), factor)

"""Line deduplication over a corpus, in DataFrame functions only.

Every line's key is hashed to 128 bits.  The hashes are range-partitioned and
each key's places are streamed in order of document and position, which tells
the documents a key is found in and its first place.  The result is not text
but one sparse bitmap of the dropped lines per document.

A key that makes up more than ``1 / HOT_KEYS`` of all lines would hold one
task.  There are fewer than ``HOT_KEYS`` of them, so they are told by a
frequency sketch, counted in two steps and joined back by broadcast; their
lines are never shuffled to one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import shared_table

SPACES = " \t\n\x0b\x0c\r"
HOT_KEYS = 1000
_TRACKED = 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLACE = ["doc_id", "tag", "pos"]


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows of an equal id apart."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return base.withColumn("tag", F.xxhash64("text"))


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def line_hashes(base: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, tag, pos, h1, h2) of every line whose key has ``min_chars`` code points."""
    lines = base.select("doc_id", "tag", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "tag", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select(*_PLACE, F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _hot(lines: DataFrame) -> DataFrame:
    """h1 of the keys that make up more than 1 / HOT_KEYS of the lines; at most HOT_KEYS rows."""
    top = lines.agg(F.expr(f"approx_top_k(h1, {HOT_KEYS}, {_TRACKED})").alias("top"), F.count("*").alias("n"))
    return top.select("n", F.inline("top").alias("h1", "found")).where(F.col("found") * HOT_KEYS > F.col("n")).select("h1")


def dropped_lines(lines: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """(doc_id, tag, pos) of the lines to drop."""
    hot = F.broadcast(shared_table(_hot(lines), "line-dedup-hot"))

    places = Window.partitionBy("h1", "h2").orderBy(*_PLACE)
    nth = F.row_number().over(places)
    new_doc = F.when((nth > 1) & F.col("doc_id").eqNullSafe(F.lag("doc_id").over(places)), 0).otherwise(1)
    runs = lines.join(hot, "h1", "left_anti").repartitionByRange("h1", "h2")
    runs = runs.select(*_PLACE, "h1", "h2", new_doc.alias("new_doc"), (nth == 1).alias("first"))
    runs = runs.withColumn("n_docs", F.sum("new_doc").over(Window.partitionBy("h1", "h2")))
    cold = runs.where(F.col("n_docs") >= min_docs)

    hot_lines = lines.join(hot, "h1")
    by_doc = hot_lines.groupBy("h1", "h2", "doc_id").agg(F.min(F.struct("tag", "pos")).alias("at"))
    counted = by_doc.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "at.tag", "at.pos")).alias("at"))
    counted = counted.where(F.col("n_docs") >= min_docs)
    warm = hot_lines.join(F.broadcast(counted), ["h1", "h2"])  # no more rows than hot keys
    warm = warm.withColumn("first", F.struct(*_PLACE) == F.col("at"))
    found = cold.select(*_PLACE, "first").unionByName(warm.select(*_PLACE, "first"))
    return (found.where(~F.col("first")) if keep_first else found).select(*_PLACE)


def drop_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, n_dropped, dropped) of the documents that lose lines.

    A key of ``min_chars`` code points or more that ``min_docs`` documents hold
    loses all its lines, or with ``keep_first`` all but the first by doc_id,
    text hash and position.  ``dropped`` is a sorted array of (word, bits): bit
    b of word w stands for line 64 * w + b, words without a bit are left out.
    ``tag`` is the text's xxhash64.  Documents are told apart by their id: rows
    of an equal id, repeated rows and all rows with a null id count as one
    document each, and each row is decided by its own lines.  A null text is
    one empty line.  An empty table gives no rows; other columns are not read.
    """
    lines = shared_table(line_hashes(_base(docs, id_col, text_col), min_chars), "line-dedup-lines")
    dropped = dropped_lines(lines, min_docs, keep_first)
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = dropped.groupBy("doc_id", "tag", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id", "tag").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row of ``docs``: its kept lines joined by newlines."""

    def with_gap(entry: Column, i: Column) -> Column:
        gap = entry["word"] - F.coalesce(F.get("dropped", i - 1)["word"], F.lit(-1)) - 1
        return F.concat(F.array_repeat(F.lit(0).cast("long"), gap), F.array(entry["bits"]))

    dense = bitmaps.select(F.col("doc_id").alias("d"), F.col("tag").alias("t"), "n_dropped", F.flatten(F.transform("dropped", with_gap)).alias("dense"))
    base = _base(docs, id_col, text_col)
    # the bitmaps are the hashed side: texts are not sorted
    rows = base.join(dense.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")), "left")
    lines = F.split("text", "\n")

    def stays(_: Column, i: Column) -> Column:
        word = F.coalesce(F.get("dense", F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
        return F.call_function("getbit", word, (i % 64).cast("int")) == 0

    kept = F.when(F.col("dense").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return rows.select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("text"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without the lines that :func:`drop_bitmaps` names: doc_id, n_lines (before), n_dropped, text."""
    return apply_bitmaps(docs, drop_bitmaps(docs, min_docs, min_chars, keep_first, id_col, text_col), id_col, text_col)


def digests(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept lines."""
    return line_dedup(docs, min_docs, min_chars).select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))

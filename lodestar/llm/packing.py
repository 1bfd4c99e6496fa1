"""Best-fit packing of documents into sequences of a fixed capacity, under conflicts.

A document longer than the capacity is cut into full pieces and a rest; no
token is dropped.  Pieces are dealt to shards of bounded size by a hash, and
each shard packs its own by best-fit decreasing: open bins are kept ordered by
residual, a piece starts at the first bin whose residual holds it and moves to
the next larger one until the bin's source and duplicate-cluster bitmaps both
are free of the piece's own bits.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import shared_table
from lodestar.llm.dedup import link
from lodestar.llm.token_counts import count_tokens

#: Words as in the other operators of the package: runs of anything but ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"
_PLACED = "bin_id string, slot int, doc_id long, piece int, start_token long, n_tokens int, bin_tokens int"


def pack(pieces: Iterable[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, slot) of each (size, source, cluster), sizes in falling order; a source or cluster is in a bin once.

    Bins are numbered as they open; equal residuals go to the older bin.
    """
    open_bins: list[tuple[int, int]] = []  # (residual, bin)
    sources: list[int] = []
    clusters: list[int] = []
    filled: list[int] = []
    placed = []
    for size, source, cluster in pieces:
        source_bit, cluster_bit = 1 << source, 1 << cluster
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (sources[open_bins[at][1]] & source_bit or clusters[open_bins[at][1]] & cluster_bit):
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
        else:
            residual, b = capacity, len(filled)
            sources.append(0)
            clusters.append(0)
            filled.append(0)
        sources[b] |= source_bit
        clusters[b] |= cluster_bit
        placed.append((b, filled[b]))
        filled[b] += 1
        if residual > size:
            insort(open_bins, (residual - size, b))
    return placed


def _pack_shard(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "doc_id", "piece", "cluster"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        # a row without a source conflicts with no other row's source
        source = group["source"].where(group["source"].notna(), "\0" + group.index.astype(str).to_series(index=group.index))
        codes = zip(group["n_tokens"].tolist(), pd.factorize(source)[0].tolist(), pd.factorize(group["cluster"])[0].tolist(), strict=True)
        bins, slots = zip(*pack(codes, capacity), strict=True)
        group["bin"], group["slot"] = bins, slots
        group["bin_tokens"] = group.groupby("bin")["n_tokens"].transform("sum")
        group["bin_id"] = str(group["shard"].iloc[0]) + "-" + group["bin"].astype(str)
        return group[["bin_id", "slot", "doc_id", "piece", "start_token", "n_tokens", "bin_tokens"]]

    return run


def measured(docs: DataFrame, spec_path: str, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, cluster (near-duplicate component), size (tokens of the tokenizer file).

    Rows without an id are linked as documents named by a hash of their text.
    A text without words has no cluster.  Texts are not shuffled here.
    """
    text = F.coalesce(text_col, F.lit(""))
    doc_id = F.col(id_col).cast("long")
    named = docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"), text.alias("text"), F.coalesce(doc_id, F.xxhash64(text)).alias("linked_id"))
    linked = link(named, width, percent, "linked_id").where("n_shingles > 0").select(F.col("doc_id").alias("linked_id"), F.col("component_id").alias("cluster")).distinct()
    sizes = count_tokens(named, spec_path, keep=("source", "linked_id"))
    return sizes.join(linked, "linked_id", "left").select("doc_id", "source", "cluster", F.col("n_tokens").alias("size"))


def _by_columns(docs: DataFrame, id_col: str, source_col: str, cluster_col: str, size_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), cluster_col, (F.col(size_col) + 1).cast("long").alias("length"))
    return rows.select("doc_id", "source", F.coalesce(cluster_col, F.xxhash64("doc_id", "source")).alias("cluster"), "length")


def _by_words(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    lowered = F.translate(F.coalesce(text_col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, SPACES), lambda w: w != "")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("words")
    ).select(
        "doc_id",
        "source",
        F.when(F.size("words") > 0, F.xxhash64("words")).otherwise(F.xxhash64("doc_id", "source")).alias("cluster"),
        (F.size("words") + 1).cast("long").alias("length"),
    )


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    shard_pieces: int = 8192,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    size_col: str | None = None,
) -> DataFrame:
    """One row per piece: bin_id, slot, doc_id, piece, start_token, n_tokens, bin_tokens.

    Tokens are the words of the text and one end token after the last.  A
    document's duplicate cluster is its word sequence with A-Z lower-cased:
    equal sequences, and the pieces of one document, never share a bin, nor do
    two documents of one source.  Null or empty text is the end token alone; a
    null source conflicts with none; a null id is packed like any other;
    repeated rows are packed each.  An empty table gives no rows.  Other
    columns are not read.  Only lengths and hashes are shuffled, to shards of
    about ``shard_pieces`` pieces, so no source or cluster lands in one task.

    With ``cluster_col`` and ``size_col`` (longs, see :func:`measured`) the
    cluster is that column's value, where it is null the row's id and source,
    tokens are as many as the size says, and the text is not read.
    """
    if (cluster_col is None) != (size_col is None):
        raise ValueError("cluster_col and size_col go together")
    sizes = _by_columns(docs, id_col, source_col, cluster_col, size_col) if cluster_col else _by_words(docs, id_col, text_col, source_col)
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(capacity).cast("long"))
    pieces = shared_table(
        sizes.select("doc_id", "source", "cluster", "length", F.posexplode(starts).alias("piece", "start_token")).select(
            "doc_id", "source", "cluster", "piece", "start_token",
            F.least(F.lit(capacity), F.col("length") - F.col("start_token")).cast("int").alias("n_tokens"),
        ),
        "packing-pieces",
    )
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(_pack_shard(capacity), _PLACED)

"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature has ``CHUNKS * CHUNK`` values of 16 bits, cut into
chunks.  By the pigeonhole principle two signatures that differ in at most
``CHUNKS * (ERRORS + 1) - 1`` values have a chunk with at most ``ERRORS``
differences.  All such chunks are met by listing the allowed errors: a key for
every choice of ``ERRORS`` values left out of a chunk.  Documents that share a
key are candidates, and links are confirmed on the full shingle sets.

Equal sets are one class from the start.  No group of one key is expanded into
its pairs.  Each document of a key is first compared with pivots.  What is
alike by signature then makes families.  Documents of one key in different
families meet in blocks of signatures, and of all alike pairs of two families
one is returned, which makes the two one family.  Last, within a family that
still has several components, the documents outside its largest component are
compared with all others of the family in blocks: sets travel once a block,
intersections come from one matrix product, and of all links between two
components one is returned.  So no step makes a row per pair of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import few, id_text, shared_table, slices
from lodestar.llm.components import components
from lodestar.llm.shingles import MinHash, mix, shingle_sets

CHUNKS, CHUNK, ERRORS = 10, 5, 1
#: Least number of equal signature values of a pair that is compared in full.  At a similarity of
#: 0.8 and 50 values a pair falls below with a probability under 1e-6.
LEAST_EQUAL = 25
#: Pivots of a key.
PIVOT_ROUNDS = 1
#: A block holds about this many documents, and about this many shingles.
BLOCK = 512
BLOCK_ITEMS = 4 << 20


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, same, signature): set size, 128-bit digest of the set, MinHash values; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(CHUNKS * CHUNK)
        salt = np.uint64(0x5851F42D4C957F2D)
        for batch in slices(batches, text_col):
            n, same, sign = [], [], []
            for items in shingle_sets(batch.column(text_col), width):
                n.append(len(items))
                same.append(np.array([mix(items).sum(dtype=np.uint64), mix(items ^ salt).sum(dtype=np.uint64)]).tobytes())
                sign.append(minhash.of(items).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(sign, pa.binary())],
                names=["doc_id", "n", "same", "signature"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, same binary, signature binary")


def chunk_keys(classes: DataFrame) -> DataFrame:
    """(key, rep): for every chunk and every choice of left-out values, the values that stay."""
    left_in = [[p for p in range(CHUNK) if p not in out] for out in combinations(range(CHUNK), ERRORS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
            rep = batch.column("rep")
            for c in range(CHUNKS):
                for i, stay in enumerate(left_in):
                    key = np.full(len(values), c * len(left_in) + i + 1, np.uint64)
                    for p in stay:
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, c, p])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), rep], names=["key", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, "key long, rep long")


def _linked(percent: int):
    """Pairs whose full sets reach ``percent``: 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(docs: DataFrame, reps: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(rep, set): the full shingle sets of the documents in ``reps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            sets = [x.tobytes() for x in shingle_sets(batch.column(text_col), width)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(sets, pa.binary())], names=["rep", "set"])

    picked = id_text(docs, id_col, text_col).join(reps, F.col(id_col) == F.col("rep"), "left_semi")
    return picked.mapInArrow(run, "rep long, set binary").where(F.length("set") > 0)


def link(docs: DataFrame, width: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when the similarity of their sets of ``width``-word
    shingles is ``percent`` / 100 or more; the component is named by its
    smallest id.  Null, empty and white-space texts have the empty set and are
    linked with nothing.  Rows that share an id are one document, linked by
    whatever one of them is linked by.  Rows without an id are linked with
    nothing: component_id is null and kept is true.  An empty table gives no
    rows.  Other columns are not read.
    """
    every = shared_table(signatures(docs, width, id_col, text_col), "dedup-signatures")
    worded = every.where("n > 0 and doc_id is not null")
    classes = worded.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = shared_table(classes, "dedup-classes")

    keys = chunk_keys(classes)
    pivots = F.array_distinct(F.array(*(F.min_by("rep", _order(turn)) for turn in range(PIVOT_ROUNDS))))
    shared = keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), pivots.alias("pivots")).where("low < high").select("key", "pivots")
    rows = shared_table(keys.join(shared, "key"), "dedup-keys")
    n_rows = rows.count()
    reps = shared_table(few(rows.select("rep").distinct(), n_rows), "dedup-reps")
    sets = shared_table(_sets(docs, reps, width, id_col, text_col), "dedup-sets")
    signed = shared_table(few(classes.join(reps, "rep", "left_semi").select("rep", "n", "signature"), n_rows), "dedup-signed")
    alone = reps.select("rep", F.col("rep").alias("label"))

    def confirmed(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(a, b) of the pairs that are alike by size and signature, and of those that are linked by their full sets."""
        a = signed.select("rep", "n", "signature").toDF("a", "n_a", "signature_a")
        b = signed.select("rep", "n", "signature").toDF("b", "n_b", "signature_b")
        near = few(few(pairs.distinct(), n_rows).join(a, "a"), n_rows).join(b, "b").where(_sizes_allow(F.col("n_a"), F.col("n_b"), percent))
        near = shared_table(few(near, n_rows).mapInArrow(_alike, "a long, b long"), "dedup-alike")
        whole = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        return near, shared_table(whole.mapInArrow(_linked(percent), "a long, b long"), "dedup-links")

    pairs = rows.select("rep", F.explode("pivots").alias("pivot")).where("rep <> pivot")
    alike, links = confirmed(pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")))
    families = _merged(alone, alike, n_rows)
    alike, across = confirmed(_across(rows.drop("pivots"), n_rows, families, signed, percent))
    families = _merged(families, alike, n_rows)
    labels = _merged(alone, links.unionByName(across), n_rows)
    labels = _merged(labels, _within(families, labels, n_rows, signed, sets, percent), n_rows)

    named = worded.select("doc_id", "same").distinct().join(classes.select("same", "rep"), "same").join(labels, "rep", "left")
    named = named.groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("named"))
    out = every.join(named, "doc_id", "left").withColumn("component_id", F.coalesce("named", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _order(turn: int):
    """A pivot of a key is its least document by this: by id at first, then by other orders."""
    return F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("signature_a", "signature_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= LEAST_EQUAL))


def _merged(labels: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """(rep, label), at most ``rows``, after joining what ``links`` (a, b) connect."""
    if links.isEmpty():
        return labels
    ends = links.join(labels.toDF("a", "label_a"), "a").join(labels.toDF("b", "label_b"), "b")
    roots = components(few(ends.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), rows))
    moved = labels.join(roots, labels["label"] == roots["node"], "left").select("rep", F.coalesce("root", "label").alias("label"))
    return shared_table(few(moved, rows), "dedup-labels")


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _across(rows: DataFrame, n_rows: int, families: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """(a, b): for any two families with alike documents under one key at least one alike pair.

    The documents outside the key's largest family meet all documents of the
    key, so a large family does not meet itself.  A key of one block a side is
    one row; the blocks of a larger one meet in pairs.
    """
    held = few(rows.join(families.toDF("rep", "label"), "rep"), n_rows)
    counts = few(held.groupBy("key", "label").agg(F.count("*").alias("count")), n_rows)
    mixed = counts.groupBy("key").agg(F.count("*").alias("several"), F.sum("count").alias("n"), F.max("count").alias("m"), F.max_by("label", "count").alias("most")).where("several > 1")
    mixed = shared_table(few(mixed.select("key", "most", *_block_counts(F.col("m") / BLOCK, (F.col("n") - F.col("m")) / BLOCK)), n_rows), "dedup-mixed")
    # the size goes with the signature, most significant byte first
    item = F.concat("signature", F.unhex(F.lpad(F.hex("n"), 16, "0")))
    held = few(held.join(mixed, "key"), n_rows).join(signed.select("rep", item.alias("item")), "rep")
    held = few(held, n_rows).withColumn("side", F.when(F.col("label") == F.col("most"), 0).otherwise(1))
    one = (F.col("blocks0") == 1) & (F.col("blocks1") == 1)
    columns = [("reps", "rep"), ("labels", "label"), ("items", "item")]
    whole = held.where(one).groupBy("key").agg(
        *(F.collect_list(F.when(F.col("side") == 1, F.col(c))).alias(f"{name}_a") for name, c in columns),
        *(F.collect_list(c).alias(f"{name}_b") for name, c in columns),
    )
    met = _meetings(held.where(~one), mixed.where(~one), "key").unionByName(whole.drop("key"))
    return met.mapInArrow(_blocks_alike(percent), "a long, b long")


def _block_counts(side0: Column, side1: Column) -> list[Column]:
    return [F.greatest(F.lit(1), F.ceil(c)).cast("int").alias(name) for name, c in (("blocks0", side0), ("blocks1", side1))]


def _meetings(members: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """(reps_a, labels_a, items_a, reps_b, labels_b, items_b): every block of side 1 with every block of its group.

    ``members`` (``group``, side, rep, label, item, blocks0, blocks1) are dealt
    to the blocks of their side by a hash; ``groups`` (``group``, blocks0,
    blocks1) name the meetings.
    """
    place = F.pmod(F.xxhash64("rep"), F.when(F.col("side") == 0, F.col("blocks0")).otherwise(F.col("blocks1"))).cast("int")
    blocks = shared_table(
        members.withColumn("block", place).groupBy(group, "side", "block").agg(F.collect_list("rep").alias("reps"), F.collect_list("label").alias("labels"), F.collect_list("item").alias("items")),
        "dedup-blocks",
    )

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    mine = groups.select(group, "blocks0", "blocks1", F.explode(upto("blocks1")).alias("block"))
    side0 = mine.select(group, "block", F.explode(upto("blocks0")).alias("other")).withColumn("other_side", F.lit(0))
    side1 = mine.select(group, "block", F.explode(F.sequence(F.col("block"), F.col("blocks1") - 1)).alias("other")).withColumn("other_side", F.lit(1))
    left = blocks.where("side = 1").select(group, "block", *(F.col(c).alias(f"{c}_a") for c in ("reps", "labels", "items")))
    right = blocks.select(group, F.col("side").alias("other_side"), F.col("block").alias("other"), *(F.col(c).alias(f"{c}_b") for c in ("reps", "labels", "items")))
    met = side0.unionByName(side1).join(left, [group, "block"]).join(right, [group, "other_side", "other"])
    return met.select("reps_a", "labels_a", "items_a", "reps_b", "labels_b", "items_b")


def _first_pairs(row: dict, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
    """Of the pairs (a, b) of a meeting's rows one for any two labels."""
    if not len(a):
        return None
    _, first = np.unique(np.stack([np.array(row["labels_a"])[a], np.array(row["labels_b"])[b]]), axis=1, return_index=True)
    a, b = np.array(row["reps_a"])[a[first]], np.array(row["reps_b"])[b[first]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _blocks_alike(percent: int):
    """One pair of alike signatures for any two different families of two blocks that have one."""

    def side(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joined = np.frombuffer(b"".join(items), np.uint8).reshape(len(items), -1)
        return np.ascontiguousarray(joined[:, :-8]).view(np.uint16), np.ascontiguousarray(joined[:, -8:]).view(">i8")[:, 0].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                (x, x_size), (y, y_size) = side(row["items_a"]), side(row["items_b"])
                may = np.array(row["labels_a"])[:, None] != np.array(row["labels_b"])[None, :]
                may &= 100 * np.minimum(x_size[:, None], y_size[None, :]) >= percent * np.maximum(x_size[:, None], y_size[None, :])
                a, b = np.nonzero(may)
                hit = np.zeros(len(a), bool)
                for at in range(0, len(a), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    hit[part] = (x[a[part]] == y[b[part]]).sum(1) >= LEAST_EQUAL
                if (pairs := _first_pairs(row, a[hit], b[hit])) is not None:
                    yield pairs

    return run


def _within(families: DataFrame, labels: DataFrame, n_rows: int, signed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between different components of a family, one at least for any two that are linked.

    Members of the family's largest component (side 0) and all others (side 1)
    are dealt to blocks by a hash, so many that one holds about BLOCK documents
    and BLOCK_ITEMS shingles.  Families of two have been compared already.
    """
    member = few(families.toDF("rep", "family").join(labels, "rep").join(signed.select("rep", "n"), "rep"), n_rows)
    counts = few(member.groupBy("family", "label").agg(F.count("*").alias("count"), F.sum("n").alias("items")), n_rows)
    open_ones = counts.groupBy("family").agg(
        F.count("*").alias("several"), F.sum("count").alias("n"), F.sum("items").alias("items"), F.max(F.struct("count", "label", "items")).alias("m")
    )
    side0 = F.greatest(F.col("m.count") / BLOCK, F.col("m.items") / BLOCK_ITEMS)
    side1 = F.greatest((F.col("n") - F.col("m.count")) / BLOCK, (F.col("items") - F.col("m.items")) / BLOCK_ITEMS)
    open_ones = open_ones.where("several > 1 and n > 2").select("family", F.col("m.label").alias("most"), *_block_counts(side0, side1))
    open_ones = shared_table(few(open_ones, n_rows), "dedup-families")
    member = few(member.join(open_ones, "family"), n_rows).withColumn("side", F.when(F.col("label") == F.col("most"), 0).otherwise(1))
    members = member.drop("n").join(sets.withColumnRenamed("set", "item"), "rep")
    return shared_table(_meetings(members, open_ones, "family").mapInArrow(_blocks_linked(percent), "a long, b long"), "dedup-links")


def _blocks_linked(percent: int):
    """One link for any two different components of two blocks that have one between them."""

    def side(sets: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(s) // 8 for s in sets])
        return np.frombuffer(b"".join(sets), np.uint64), np.repeat(np.arange(len(sets)), sizes), sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x, x_row, x_size = side(row["items_a"])
                y, y_row, y_size = side(row["items_b"])
                common = np.intersect1d(x, y)
                both = np.zeros((len(x_size), len(y_size)))
                for at in range(0, len(common), 4096):
                    part = common[at : at + 4096]
                    hit = []
                    for items, rows, n in ((x, x_row, len(x_size)), (y, y_row, len(y_size))):
                        where = np.minimum(np.searchsorted(part, items), len(part) - 1)
                        is_in = part[where] == items
                        grid = np.zeros((n, len(part)), np.float32)
                        grid[rows[is_in], where[is_in]] = 1
                        hit.append(grid)
                    both += hit[0] @ hit[1].T
                x_label, y_label = np.array(row["labels_a"]), np.array(row["labels_b"])
                union = x_size[:, None] + y_size[None, :] - both
                a, b = np.nonzero((100 * both >= percent * union) & (x_label[:, None] != y_label[None, :]))
                if (pairs := _first_pairs(row, a, b)) is not None:
                    yield pairs

    return run


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component of :func:`link`, the one with the smallest id.

    All columns stay.  Rows without an id stay; rows equal in every column
    count as copies, so one of them stays.
    """
    gone = link(docs, width, percent, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti").dropDuplicates()

"""Exact top-k by inner product with KD-trees, one per shard of the vectors.

Vectors are dealt to shards of bounded size by a hash of their id.  A shard's
tree splits at the median of its widest dimension; each leaf carries the
tight box around its vectors.  For a query the largest inner product within a
box is ``sum(max(q*lo, q*hi))``.  Leaves are visited best bound first and a
search ends when the next bound is below the k-th score so far.  The k-th
score starts from a first pass of every query block over one home shard, so
later shards already prune with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import shared_table

_HIT = "query_id long, vec_id long, score long"
_LOWEST = np.iinfo(np.int64).min


def quantised(rows: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v, dims): floor(scale * x) of every component, x as double; unusable vectors go."""
    x = F.transform(vec_col, lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"),
        F.size(vec_col).alias("dims"),
    )


class Tree:
    """KD-tree over the rows of one shard; leaves hold ``leaf`` rows at most unless they are all equal."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 128):
        order, cuts, stack = [], [], [np.lexsort((ids,))]
        while stack:
            rows = stack.pop()
            if len(rows) > leaf and vectors.shape[1]:
                spread = vectors[rows].max(0) - vectors[rows].min(0)
                dim = int(np.argmax(spread))
                if spread[dim] > 0:
                    middle = len(rows) // 2
                    part = rows[np.argpartition(vectors[rows, dim], middle)]
                    stack += [part[middle:], part[:middle]]
                    continue
            order.append(rows)
            cuts.append(len(rows))
        self.start = np.concatenate([[0], np.cumsum(cuts)]).astype(int)
        order = np.concatenate(order)
        self.ids, self.vectors = ids[order], vectors[order]
        self.lo = np.array([self.vectors[a:b].min(0) for a, b in zip(self.start, self.start[1:], strict=False)])
        self.hi = np.array([self.vectors[a:b].max(0) for a, b in zip(self.start, self.start[1:], strict=False)])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query index, ids, scores) of each query's best k here with a score of ``least`` or more."""
        bounds = np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T
        visit = np.argsort(-bounds, axis=1, kind="stable")
        for i, query in enumerate(queries):
            ids, scores, floor = np.empty(0, np.int64), np.empty(0, queries.dtype), least[i]
            for leaf in visit[i]:
                if bounds[i, leaf] < floor:
                    break
                a, b = self.start[leaf], self.start[leaf + 1]
                found = self.vectors[a:b] @ query
                take = (found >= floor) & (self.ids[a:b] != query_ids[i])
                if take.any():
                    ids, scores = np.concatenate([ids, self.ids[a:b][take]]), np.concatenate([scores, found[take]])
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    if len(ids) == k:
                        floor = max(floor, scores[-1])
            yield i, ids, scores


def _matrix(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, dims)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As float64 where every inner product is an exact float, else as the 64-bit integers they are."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return (a.astype(np.float64), b.astype(np.float64)) if largest < 2**53 else (a, b)


def _packed(rows: DataFrame, key: str, total: int) -> DataFrame:
    """About equal parts by a hash of the id, each one binary row: (dims, key, ids, vectors, floors)."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[:1]
        return pd.DataFrame(
            {
                "dims": first["dims"].astype("int32"),
                key: first[key].astype("int32"),
                f"{key}_ids": [group["vec_id"].to_numpy(np.int64).tobytes()],
                f"{key}_vectors": [np.stack(group["v"].to_numpy()).astype(np.int64).tobytes()],
                f"{key}_floors": [group["floor"].to_numpy(np.int64).tobytes()],
            }
        )

    return rows.withColumn(key, F.pmod(F.xxhash64("vec_id"), F.lit(total)).cast("int")).groupBy("dims", key).applyInPandas(
        pack, f"dims int, {key} int, {key}_ids binary, {key}_vectors binary, {key}_floors binary"
    )


def top_k(
    rows: DataFrame,
    k: int = 5,
    query_every: int = 50,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 256,
    shard_rows: int = 8192,
    block_rows: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows, ties to the smaller id.

    Queries are the rows whose id is divisible by ``query_every``; all usable
    rows are candidates.  Vectors that are null or empty, or hold null or
    non-finite components, and rows without an id take no part.  Only vectors
    of the same length have a score.  Rows that share an id are one another's
    own row: none is the other's neighbour, and as queries the least vector
    stands for them; as candidates each counts.  Fewer than k candidates: all
    of them.  An empty table gives no rows.
    """
    usable = shared_table(quantised(rows, id_col, vec_col, scale), "topk-vectors").withColumn("floor", F.lit(_LOWEST))
    asked = usable.where(F.pmod("vec_id", F.lit(query_every)) == 0).groupBy("vec_id", "dims").agg(F.min("v").alias("v"))
    n_rows, n_asked = usable.count(), asked.count()
    n_blocks = max(1, -(-n_asked // block_rows))
    shards = shared_table(_packed(usable, "shard", max(1, -(-n_rows // shard_rows))), "topk-shards")
    places = shards.groupBy("dims").agg(F.sort_array(F.collect_list("shard")).alias("shards"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                queries, vectors = _exact(_matrix(r["block_vectors"], r["dims"]), _matrix(r["shard_vectors"], r["dims"]))
                ids = np.frombuffer(r["block_ids"], np.int64)
                tree = Tree(np.frombuffer(r["shard_ids"], np.int64), vectors)
                found = tree.search(ids, queries, np.frombuffer(r["block_floors"], np.int64), k)
                out = [(np.full(len(n), ids[i]), n, s) for i, n, s in found if len(n)]
                if out:
                    columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    def searched(blocks: DataFrame, shard: Column) -> DataFrame:
        pairs = blocks.join(places, "dims").withColumn("shard", shard).drop("shards")
        return pairs.join(shards.drop("shard_floors"), ["dims", "shard"]).mapInArrow(search, _HIT)

    def ranked(hits: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    home = F.pmod("block", F.size("shards"))
    first = shared_table(searched(_packed(asked.withColumn("floor", F.lit(_LOWEST)), "block", n_blocks), F.col("shards")[home]), "topk-first")
    floors = ranked(first).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    known = asked.join(floors, "vec_id", "left").fillna(_LOWEST, "floor")
    others = F.filter("shards", lambda s: s != F.col("shards")[home])
    rest = searched(_packed(known, "block", n_blocks), F.explode(others))
    return ranked(first.unionByName(rest)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

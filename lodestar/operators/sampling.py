"""Samples and splits by a row hash that another engine can repeat.

The hash of a row is the first 60 bits of the MD5 of its seed and key values
as text, joined by bars.  Samples of an exact size need the n-th smallest hash:
it is found from counts of hash prefixes, refined in the one bin that holds
it, so no task ever holds more than its own partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 60
_STEP_BITS = 15  # a refinement collects at most 2**15 counts per cut
_NULL = "\\N"


def row_hash(key: Sequence[str] | str, seed: int = 42) -> Column:
    """0 to 2**60 - 1: first 15 hex digits of md5('seed|key1|key2..'); NULL is written as \\N.

    Equal in any engine as long as the text of the key values is: use
    integers, text or dates as keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit(_NULL)) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_sql(key: Sequence[str], seed: int = 42) -> str:
    """DuckDB text of :func:`row_hash`."""
    parts = ", ".join(f"coalesce({k}::VARCHAR, '{_NULL}')" for k in key)
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), 1, {HASH_BITS // 4}))::BIGINT"


def fold_of(key: Sequence[str] | str, folds: int, seed: int = 42) -> Column:
    """Fold 0 to ``folds`` - 1 of a row."""
    return F.pmod(row_hash(key, seed), F.lit(folds)).cast("int")


def hash_sample(df: DataFrame, fraction: float, key: Sequence[str] | str, seed: int = 42) -> DataFrame:
    """Rows whose hash lies below ``fraction`` of its range: a Bernoulli sample that any engine repeats."""
    cut = round(Fraction(fraction) * 2**HASH_BITS)
    return df.where(row_hash(key, seed) < F.lit(cut))


def _refined(hashes: DataFrame, ranks: Sequence[int]) -> dict[int, tuple[int, int, int]]:
    """rank -> (the hash of the rank-th smallest row from 1, rows with smaller hashes, rows with that hash)."""
    prefix, before, held = dict.fromkeys(ranks, 0), dict.fromkeys(ranks, 0), dict.fromkeys(ranks, 0)
    shift = HASH_BITS
    while ranks and shift:
        # few enough rows in the bins that hold the cuts: take their whole hashes
        few = held[ranks[0]] and sum(held[r] for r in ranks) <= 1 << _STEP_BITS
        last, shift = shift, 0 if few else shift - _STEP_BITS
        inside = hashes if last == HASH_BITS else hashes.where(F.shiftright("__h", last).isin(sorted(set(prefix.values()))))
        bins = inside.groupBy(F.shiftright("__h", shift).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
        bins.sort(key=lambda b: b["bin"])
        for r in ranks:
            for b in bins:
                if b["bin"] >> (last - shift) != prefix[r]:
                    continue
                if before[r] + b["n"] >= r:
                    prefix[r], held[r] = b["bin"], b["n"]
                    break
                before[r] += b["n"]
    return {r: (prefix[r], before[r], held[r]) for r in ranks}


def split_by_sizes(df: DataFrame, sizes: Mapping[str, int], key: Sequence[str] | str | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """Disjoint parts of exactly the given sizes, in order of the row hash; rows beyond their sum are in none.

    ``key`` (default: all columns) should tell rows apart.  Rows of one hash
    that a cut divides are ordered by all columns, then arbitrarily.  Parts
    are as large as the rows allow, in the order given.
    """
    keys = [key] if isinstance(key, str) else list(key or df.columns)
    hashed = df.withColumn("__h", row_hash(keys, seed))
    total = df.count()
    ends, done = [], 0
    for size in sizes.values():
        if size < 0:
            raise ValueError("sizes must not be negative")
        done = min(total, done + size)
        ends.append(done)
    found = _refined(hashed.select("__h"), sorted({e for e in ends if 0 < e < total}))
    divided = {r: cut for r, cut in found.items() if r - cut[1] < cut[2]}
    if divided:
        hot = F.col("__h").isin(sorted({h for h, _, _ in divided.values()}))
        order = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        ties = _positions(hashed.where(hot), order)
        hashed = hashed.where(~hot).withColumn("__pos", F.lit(0).cast("long")).unionByName(ties)

    def below(end: int) -> Column:
        if end in (0, total):
            return F.lit(end == total)
        h, before, _ = found[end]
        if end in divided:
            return (F.col("__h") < h) | ((F.col("__h") == h) & (F.col("__pos") < end - before))
        return F.col("__h") <= h

    out, start = {}, 0
    for name, end in zip(sizes, ends, strict=True):
        out[name] = hashed.where(below(end) & ~below(start)).select(*[f"`{c}`" for c in df.columns])
        start = end
    return out


def _positions(ties: DataFrame, order: list[Column]) -> DataFrame:
    """``ties`` with __pos, the position within the rows of one hash; rows equal in all columns may be many, so they are told apart by place."""
    from lodestar.operators.windows import global_positions

    placed = ties.withColumn("__place", F.monotonically_increasing_id())
    return global_positions(placed, [*order, F.col("__place")], pos_col="__pos", by=["__h"]).drop("__place")


def split_by_weights(df: DataFrame, weights: Mapping[str, float], key: Sequence[str] | str | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """Parts of exact sizes that cover ``df``: cuts at the rounded cumulative shares."""
    whole, n, done, sizes, last = sum(Fraction(w) for w in weights.values()), df.count(), Fraction(0), {}, 0
    for name, weight in weights.items():
        done += Fraction(weight)
        end = int(done / whole * n + Fraction(1, 2))
        sizes[name], last = end - last, end
    return split_by_sizes(df, sizes, key, seed)


def sample_exact(df: DataFrame, n: int, key: Sequence[str] | str | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, count)`` rows, those of the smallest hashes."""
    return split_by_sizes(df, {"sample": n}, key, seed)["sample"]

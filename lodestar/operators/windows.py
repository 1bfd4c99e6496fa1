"""Window-style operators (W01-W10, O04) built to survive skew.

A window with no partition key, or a partition key that holds a third of the
rows, puts that many rows into one task.  The functions here keep every
per-task sort bounded:

* ``top_k_with_ties`` ranks inside (group, salt) sub-groups first (Spark
  pushes a per-partition group limit below the shuffle), then ranks the few
  surviving distinct values per group.
* ``rank_within`` ranks distinct (group, value) pairs after a map-side
  pre-aggregation, then joins the rank back to the rows (NULL equals NULL).
* ``ntile`` numbers rows globally from range partitions plus per-partition
  offsets, instead of one global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.scalar import round_half_up, scalar_of
from lodestar.operators.joins import null_safe_join
from lodestar.session import reliable_checkpoint

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _order(c: str, descending: bool) -> Column:
    return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()


def top_k_with_ties(
    df: DataFrame,
    order_col: str,
    k: int,
    by: str | Sequence[str] | None = None,
    descending: bool = True,
    rank_col: str = "rank",
    salt_buckets: int | None = None,
) -> DataFrame:
    """Rows whose ``min_rank`` within ``by`` is <= k; ties at the cut are kept.

    rank = 1 + number of rows of the group strictly ahead in the order.  Rows
    with a NULL ``order_col`` get no rank and are dropped, as ``min_rank``
    gives NA there.

    ``rank() <= k`` lets Spark place a partial group limit below the shuffle:
    every map task ships at most k rows per group (plus ties at its cut), so
    even a group holding a third of all rows reaches its final task as at
    most (map tasks x k) rows.  Spark only does this for k up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``; above it the rows are
    first ranked inside (group, salt) sub-groups, which is exact because
    every row ahead of a row with global rank <= k also has rank <= k in its
    own sub-group.
    """
    keys = _as_list(by)
    rows = df.where(F.col(order_col).isNotNull())
    if salt_buckets is None:
        threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
        salt_buckets = 1 if k <= threshold else 64
    if salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
        local_w = Window.partitionBy(*keys, "__salt").orderBy(_order(order_col, descending))
        rows = (
            rows.withColumn("__salt", salt)
            .withColumn("__local_rank", F.rank().over(local_w))
            .where(F.col("__local_rank") <= k)
            .drop("__salt", "__local_rank")
        )
    group_w = Window.partitionBy(*keys).orderBy(_order(order_col, descending))
    return rows.withColumn(rank_col, F.rank().over(group_w).cast("long")).where(F.col(rank_col) <= k)


def ahead_counts(
    dist: DataFrame,
    keys: list[str],
    value: str,
    count_col: str,
    descending: bool = True,
    out_col: str = "__ahead",
    total_col: str | None = None,
) -> DataFrame:
    """For distinct (group, value, count) rows: rows of the group strictly ahead in the order.

    The rows are range-partitioned by (group, value), whose cut points follow
    the data, so neither a hot group nor a far outlier fills a partition.  Each
    (partition, group) piece has its running counts; the offsets of the pieces
    come from a table of partitions + groups rows at most.  ``value`` may be of
    any ordered type.  ``total_col`` adds the group's number of rows.
    """
    full = [*[F.col(k).asc_nulls_last() for k in keys], _order(value, descending)]
    ranged = reliable_checkpoint(dist.repartitionByRange(*full).withColumn("__pid", F.spark_partition_id()))
    pieces = ranged.groupBy("__pid", *keys).agg(F.sum(count_col).alias("__cnt"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__start", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
    if total_col:
        pieces = pieces.withColumn(total_col, F.sum("__cnt").over(Window.partitionBy(*keys)))
    local = Window.partitionBy("__pid", *keys).orderBy(_order(value, descending)).rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("__local", F.coalesce(F.sum(count_col).over(local), F.lit(0)))
    out = null_safe_join(counted, pieces.drop("__cnt"), ["__pid", *keys])
    return out.withColumn(out_col, F.col("__start") + F.col("__local")).drop("__pid", "__start", "__local")


def rank_within(
    df: DataFrame,
    order_col: str,
    by: str | Sequence[str] | None = None,
    descending: bool = True,
    rank_col: str = "rank",
) -> DataFrame:
    """SQL ``rank()`` of every row within ``by`` (W03), NULL order values get NULL.

    rank = 1 + rows of the group strictly ahead.  Ranks are computed on
    distinct (group, value) pairs, pre-aggregated on the map side, with the
    running counts of ``ahead_counts``, then joined back to the rows; rows with
    a NULL group key form a group like any other.
    """
    keys = _as_list(by)
    # the distinct (group, value) table feeds four consumers; materialise it once
    dist = reliable_checkpoint(
        df.where(F.col(order_col).isNotNull())
        .groupBy(*keys, order_col)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranks = ahead_counts(dist, keys, order_col, "__n", descending).select(
        *keys, order_col, (F.col("__ahead") + F.lit(1)).alias(rank_col)
    )
    return null_safe_join(df, ranks, [*keys, order_col], "left").select(*df.columns, rank_col)


def extremes(df: DataFrame, value_col: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Rows equal to their group's min or max of ``value_col``, ties kept.

    Group min/max come from a partial aggregation and are joined back on the
    group key, so no task holds a whole group.
    """
    keys = _as_list(by)
    stats = df.groupBy(*keys).agg(
        F.min(value_col).alias("__min"), F.max(value_col).alias("__max")
    )
    joined = null_safe_join(df, stats, keys) if keys else df.withColumns(
        {"__min": scalar_of(df, F.min(value_col)), "__max": scalar_of(df, F.max(value_col))}
    )
    return joined.where(
        (F.col(value_col) == F.col("__min")) | (F.col(value_col) == F.col("__max"))
    ).drop("__min", "__max")


def _tile_of(pos: Column, total: Column, n_tiles: int) -> Column:
    """SQL ``ntile`` rule for a 0-based position: the first ``N % n`` tiles get one extra row."""
    n = F.lit(n_tiles)
    q = F.floor(total / n)
    r = total - q * n
    big = r * (q + F.lit(1))
    return (
        F.when(pos < big, F.floor(pos / (q + F.lit(1))) + F.lit(1))
        .otherwise(r + F.floor((pos - big) / F.greatest(q, F.lit(1))) + F.lit(1))
        .cast("long")
    )


def _ranged(df: DataFrame, partitions: int | None, order: Sequence[Column]) -> DataFrame:
    """Range partitions; without a number, the session's, which adaptive execution merges by size."""
    return df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)


def global_positions(
    df: DataFrame,
    order: Sequence[Column],
    partitions: int | None = None,
    pos_col: str = "__pos",
    total_col: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Attach the 0-based position of each row in ``order`` within its ``by`` group.

    Range-partition on (group, order), sort inside partitions and checkpoint
    to the shared folder, so counts and rows see the same partitioning even
    after a lost executor.  Position = rows of the group in earlier
    partitions + index inside the partition.  The offsets table has one row
    per (partition, group) piece: at most partitions + groups rows.  A hot
    group is spread over many range partitions.
    """
    keys = list(by)
    full = [*[F.col(k).asc_nulls_last() for k in keys], *order]
    ranged = reliable_checkpoint(_ranged(df, partitions, full).sortWithinPartitions(*full))
    ids = ranged.withColumn("__mid", F.monotonically_increasing_id()).withColumns(
        {
            "__pid": F.shiftright("__mid", _LOCAL_BITS),
            "__local": F.col("__mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    )
    pieces = ids.groupBy("__pid", *keys).agg(
        F.count(F.lit(1)).alias("__cnt"), F.min("__local").alias("__first")
    )
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__offset", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
    if total_col:
        whole = Window.partitionBy(*keys)
        pieces = pieces.withColumn(total_col, F.sum("__cnt").over(whole))
    pieces = pieces.drop("__cnt")
    out = null_safe_join(ids, pieces, ["__pid", *keys]).withColumn(
        pos_col, F.col("__offset") + F.col("__local") - F.col("__first")
    )
    return out.drop("__mid", "__pid", "__local", "__offset", "__first")


def ntile(
    df: DataFrame,
    n_tiles: int,
    order: Sequence[Column],
    tile_col: str = "tile",
    partitions: int | None = None,
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """``ntile(n) OVER ([PARTITION BY by] ORDER BY order)`` without a single-partition window.

    ``order`` should be total (append a unique key) for a deterministic result.
    """
    pos = global_positions(df, order, partitions, total_col="__total", by=_as_list(by))
    return pos.withColumn(tile_col, _tile_of(F.col("__pos"), F.col("__total"), n_tiles)).drop("__pos", "__total")


def ntile_window(df: DataFrame, n_tiles: int, order: Sequence[Column], tile_col: str = "tile", by=None) -> DataFrame:
    """Single-window reference form of ``ntile`` for small inputs and tests."""
    w = Window.partitionBy(*_as_list(by)).orderBy(*order)
    return df.withColumn(tile_col, F.ntile(n_tiles).over(w).cast("long"))


def share_of_total(df: DataFrame, value_col: str, out_col: str = "prop") -> DataFrame:
    """``value / sum(value)`` over the whole frame (W06); the sum is a scalar subquery."""
    return df.withColumn(out_col, F.col(value_col) / scalar_of(df, F.sum(value_col)))


def cumulative_sum(
    df: DataFrame,
    order: Sequence[Column],
    value_col: str,
    out_col: str = "cum",
    partitions: int | None = None,
) -> DataFrame:
    """Running sum in ``order`` with a ROWS frame (W07), as SQL has it: a NULL adds
    nothing, and rows before the first value have NULL.

    Per-range-partition running sums plus the offsets of the partitions before.
    """
    ranged = reliable_checkpoint(_ranged(df, partitions, order).withColumn("__pid", F.spark_partition_id()))
    local_w = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("__pid").agg(F.sum(value_col).alias("__part"))
    totals = totals.withColumn("__offset", F.sum("__part").over(before)).drop("__part")
    summed = ranged.withColumn("__local", F.sum(value_col).over(local_w)).join(totals, on="__pid")
    both = F.coalesce(F.col("__offset") + F.col("__local"), F.col("__offset"), F.col("__local"))
    return summed.withColumn(out_col, both).drop("__pid", "__local", "__offset")


def impute_mean(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Replace NULL with the whole-column mean (W08), via a scalar subquery."""
    return df.withColumn(out_col or col, F.coalesce(F.col(col), scalar_of(df, F.avg(col))))


def rescale_min_max(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """``(x - min) / (max - min)`` over the whole column (W09); NULL when max = min."""
    lo, hi = scalar_of(df, F.min(col)), scalar_of(df, F.max(col))
    return df.withColumn(out_col or col, F.try_divide(F.col(col) - lo, hi - lo))


def normalize_by_max(df: DataFrame, col: str, out_col: str, digits: int = 2) -> DataFrame:
    """``round(x / max(x), digits)``."""
    return df.withColumn(out_col, round_half_up(F.col(col) / scalar_of(df, F.max(col)), digits))

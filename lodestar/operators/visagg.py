"""Aggregates behind plots of very large tables.

Each is one plan: the limits (min / max) are scalar subqueries that Spark
evaluates once and merges into a single scan, the per-row arithmetic stays in
codegen, and only cells (at most ``bins`` or ``(res+1)^2`` per facet) leave
the aggregation.  Degenerate limits (max = min) put everything in cell 0
instead of raising a division error.

The input is read twice (limits, then cells).  That is cheap for a table
scan of one or two columns, and for a joined input adaptive execution
reuses the identical shuffle stages between the limits subquery and the
cell aggregation, so only the reduce side runs twice.  When the input has
expensive work outside exchanges, ``materialize=True`` writes the projected
columns once to the shared checkpoint folder instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.defaults import HISTOGRAM_BINS, QUICK_HISTOGRAM_BREAKS, RASTER_RESOLUTION, TILE_RESOLUTION
from lodestar.functions.scalar import col_of, round_half_up, scalar_of
from lodestar.session import reliable_checkpoint


def _prepared(data: DataFrame, materialize: bool) -> DataFrame:
    return reliable_checkpoint(data) if materialize else data


def _scaled(x: Column, lo: Column, rng: Column, res: int) -> Column:
    """``round((x - lo) / rng * res)`` half up as a cell index, 0 when the range is empty."""
    return F.when(rng == 0, F.lit(0)).otherwise(round_half_up((x - lo) / rng * F.lit(res), 0))


def histogram(df: DataFrame, x: str | Column, bins: int = HISTOGRAM_BINS, materialize: bool = False) -> DataFrame:
    """Fixed-width histogram (V01, J06): ``(bin, count, bin_floor)`` for every bin 0..bins-1.

    bin = least(floor((x - min) / w), bins - 1) with w = (max - min) / bins,
    i.e. left-closed bins with the last one closed; empty bins are filled
    with 0 by a join against the complete bin list (``bins`` rows).
    """
    data = _prepared(df.select(col_of(x).cast("double").alias("x")).where(F.col("x").isNotNull()), materialize)
    lo = scalar_of(data, F.min("x"))
    hi = scalar_of(data, F.max("x"))
    w = (hi - lo) / F.lit(bins)
    b = F.when(w == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("x") - lo) / w), F.lit(bins - 1)))
    counts = data.withColumn("bin", b.cast("long")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").alias("bin"))
    return (
        all_bins.join(F.broadcast(counts), on="bin", how="left")
        .select(
            "bin",
            F.coalesce(F.col("count"), F.lit(0)).alias("count"),
            (lo + F.col("bin") * w).alias("bin_floor"),
        )
    )


def raster(
    df: DataFrame, x: str | Column, y: str | Column, resolution: int = RASTER_RESOLUTION,
    facet: str | Column | None = None, materialize: bool = False,
) -> DataFrame:
    """Counts per raster cell (V02); with ``facet`` per facet value.

    The limits are global over all facets, as in the original; cells run
    0..resolution on each axis.  Output: [facet], res_x, res_y, n plus the
    limits, so the caller can draw axes without another pass.
    """
    cols = [col_of(x).alias("x"), col_of(y).alias("y")]
    if facet is not None:
        cols.insert(0, col_of(facet).alias("g"))
    data = _prepared(df.select(*cols).where(F.col("x").isNotNull() & F.col("y").isNotNull()), materialize)
    min_x, max_x = scalar_of(data, F.min("x")), scalar_of(data, F.max("x"))
    min_y, max_y = scalar_of(data, F.min("y")), scalar_of(data, F.max("y"))
    keys = [] if facet is None else ["g"]
    cells = data.withColumns({
        "res_x": _scaled(F.col("x"), min_x, max_x - min_x, resolution),
        "res_y": _scaled(F.col("y"), min_y, max_y - min_y, resolution),
    }).groupBy(*keys, "res_x", "res_y").agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumns({"min_x": min_x, "max_x": max_x, "min_y": min_y, "max_y": max_y})


def tiles(df: DataFrame, x: str | Column, y: str | Column, resolution: int = TILE_RESOLUTION, materialize: bool = False) -> DataFrame:
    """Raster cells with ``alpha = round(freq / max(freq), 2)``."""
    cells = raster(df, x, y, resolution, materialize=materialize).select("res_x", "res_y", F.col("n").alias("freq"))
    return cells.withColumn("alpha", round_half_up(F.col("freq") / scalar_of(cells, F.max("freq")), 2))


def boxbin(
    df: DataFrame, x: str | Column, y: str | Column, color: str | Column | None = None,
    resolution: int = RASTER_RESOLUTION, materialize: bool = False,
) -> DataFrame:
    """Raster coloured by frequency or by the mean of a third column.

    Frequency mode: ``res_color = round(n / max(n), 2)``.  Colour mode:
    ``res_color = round(mean(color) / max(color), 2)`` with ``max(color)``
    over the filtered input rows.
    """
    cols = [col_of(x).alias("x"), col_of(y).alias("y")]
    if color is not None:
        cols.append(col_of(color).alias("c"))
    data = _prepared(df.select(*cols).where(F.col("x").isNotNull() & F.col("y").isNotNull()), materialize)
    min_x, max_x = scalar_of(data, F.min("x")), scalar_of(data, F.max("x"))
    min_y, max_y = scalar_of(data, F.min("y")), scalar_of(data, F.max("y"))
    grouped = data.withColumns({
        "res_x": _scaled(F.col("x"), min_x, max_x - min_x, resolution),
        "res_y": _scaled(F.col("y"), min_y, max_y - min_y, resolution),
    }).groupBy("res_x", "res_y")
    if color is None:
        cells = grouped.agg(F.count(F.lit(1)).alias("__v"))
        top = scalar_of(cells, F.max("__v"))
    else:
        cells = grouped.agg(F.avg("c").alias("__v"))
        top = scalar_of(data, F.max("c"))
    return cells.select("res_x", "res_y", round_half_up(F.try_divide(F.col("__v"), top), 2).alias("res_color"))


def quick_histogram(df: DataFrame, x: str | Column, breaks: int = QUICK_HISTOGRAM_BREAKS, materialize: bool = False) -> DataFrame:
    """Buckets ``round(x / (max / (breaks - 1)))`` with origin 0 (V06):
    per bucket the observed top, bottom and count."""
    data = _prepared(df.select(col_of(x).cast("double").alias("x")).where(F.col("x").isNotNull()), materialize)
    width = scalar_of(data, F.max("x")) / F.lit(breaks - 1)
    bucket = F.when(width == 0, F.lit(0)).otherwise(round_half_up(F.col("x") / width, 0))
    return data.withColumn("bucket", bucket).groupBy("bucket").agg(
        F.max("x").alias("top"), F.min("x").alias("bottom"), F.count(F.lit(1)).alias("count")
    )


def point_frequency(df: DataFrame, x: str | Column, y: str | Column) -> DataFrame:
    """Exact ``(x, y, n)`` point counts."""
    return df.groupBy(col_of(x).alias("x"), col_of(y).alias("y")).agg(F.count(F.lit(1)).alias("n"))

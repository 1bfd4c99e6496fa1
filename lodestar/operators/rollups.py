"""Aggregation and reshape.

All summaries are one ``groupBy().agg()`` (partial + final aggregation, so a
hot key is combined on the map side before the shuffle).  Whole-table values
needed per row come from scalar subqueries, never from a window without a
partition key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.defaults import BOX_WHISKER_IQR, PROFILE_PROBABILITIES
from lodestar.functions.scalar import col_of, round_half_up, round_to_hour, scalar_of
from lodestar.operators.joins import null_safe_join


def _as_list(cols) -> list:
    if cols is None:
        return []
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """One-row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, by, name: str = "n") -> DataFrame:
    """``count(a, b)`` / ``tally()``."""
    return df.groupBy(*_as_list(by)).agg(F.count(F.lit(1)).alias(name))


def weighted_count(df: DataFrame, by, weight: str | Column, name: str = "n") -> DataFrame:
    """``count(by, wt = w)``: sum of the weight per group."""
    return df.groupBy(*_as_list(by)).agg(F.sum(col_of(weight)).alias(name))


def summarize(df: DataFrame, by, measures: Mapping[str, Column]) -> DataFrame:
    """One grouped pass computing named measures (A04-A11, A13 with ``.where``)."""
    return df.groupBy(*_as_list(by)).agg(*[c.alias(n) for n, c in measures.items()])


def percentile_columns(
    value: str | Column,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    method: str = "exact",
    accuracy: int = 10_000,
) -> list[Column]:
    """Percentile measures with linear interpolation.

    ``exact`` is SQL ``percentile`` (DuckDB ``quantile_cont``); its buffer per
    group grows with the group's distinct values, which are bounded for
    money / duration columns.  ``approx`` is ``percentile_approx`` with a
    fixed-size sketch per group for unbounded-cardinality columns.
    """
    c = col_of(value)
    names = list(names or [f"p{int(round(p * 100)):02d}" for p in probs])
    if method == "exact":
        arr = F.percentile(c, F.array(*[F.lit(float(p)) for p in probs]))
    elif method == "approx":
        arr = F.percentile_approx(c, [float(p) for p in probs], accuracy)
    else:
        raise ValueError(f"unknown percentile method {method!r}")
    return [arr[i].alias(n) for i, n in enumerate(names)]


def profile(
    df: DataFrame,
    by,
    value: str | Column,
    probs: Sequence[float] = PROFILE_PROBABILITIES,
    method: str = "exact",
) -> DataFrame:
    """n, mean and percentiles of ``value`` per group.

    ``exact`` / ``approx``: one aggregation with SQL ``percentile`` /
    ``percentile_approx``; right for many small groups.  ``distributed``:
    exact values from ``percentile_table``, for few large (or skewed) groups,
    where the built-in would end in one merge task per group.
    """
    c = col_of(value)
    if method != "distributed":
        pcols = percentile_columns(c, probs, method=method)
        return df.groupBy(*_as_list(by)).agg(F.count(F.lit(1)).alias("n"), F.avg(c).alias("mean"), *pcols)
    keys = _as_list(by)
    if any(isinstance(k, Column) for k in keys):
        raise ValueError("method='distributed' takes group column names; add derived keys with withColumn first")
    base = df.select(*keys, c.alias("__v"))
    # n, mean and percentiles from one materialised distinct table: one pass over the rows
    return percentile_table(base, keys, "__v", probs, with_moments=True)


def grain_rollup(
    df: DataFrame,
    grains: Mapping[str, Sequence[str]],
    measures: Mapping[str, Column],
    grain_col: str = "grain",
) -> DataFrame:
    """The same measures at several grains in one scan.

    ``grains`` maps a grain name to its key columns, finest first; the output
    carries the union of keys (NULL where a key is rolled up) and the grain
    name derived from ``grouping()``.
    """
    keys: list[str] = []
    for cols in grains.values():
        for c in cols:
            if c not in keys:
                keys.append(c)
    sets = [[F.col(c) for c in cols] for cols in grains.values()]
    grouped = df.groupingSets(sets, *keys).agg(
        *[c.alias(n) for n, c in measures.items()],
        *[F.grouping(c).alias(f"__g_{c}") for c in keys],
    )
    label = None
    for name, cols in grains.items():
        cond = None
        for c in keys:
            bit = F.col(f"__g_{c}") == (0 if c in cols else 1)
            cond = bit if cond is None else cond & bit
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return grouped.withColumn(grain_col, label).drop(*[f"__g_{c}" for c in keys])


def regroup_mean(
    df: DataFrame, inner_by, outer_by, value: str | Column, inner_name: str, outer_name: str
) -> DataFrame:
    """Mean per inner group, then unweighted mean of those means per outer group."""
    inner = df.groupBy(*_as_list(inner_by)).agg(F.avg(col_of(value)).alias(inner_name))
    return inner.groupBy(*_as_list(outer_by)).agg(
        F.count(F.lit(1)).alias("n_groups"), F.avg(inner_name).alias(outer_name)
    )


def weighted_mean(df: DataFrame, by, x: str | Column, w: str | Column, name: str, digits: int | None = 0) -> DataFrame:
    """``round(sum(x * w) / sum(w), digits)`` per group."""
    val = F.try_divide(F.sum(col_of(x) * col_of(w)), F.sum(col_of(w)))
    if digits is not None:
        val = round_half_up(val, digits)
    return df.groupBy(*_as_list(by)).agg(val.alias(name))


def ratio_of_means(df: DataFrame, by, num: str | Column, den: str | Column, name: str) -> DataFrame:
    """``mean(num) / mean(den)`` per group."""
    return df.groupBy(*_as_list(by)).agg(
        F.avg(col_of(num)).alias(f"mean_{name}_num"),
        F.avg(col_of(den)).alias(f"mean_{name}_den"),
    ).withColumn(name, F.try_divide(F.col(f"mean_{name}_num"), F.col(f"mean_{name}_den")))


def class_sums(df: DataFrame, by, class_col: str, classes: Sequence, value: str | Column | None = None, prefix: str = "") -> DataFrame:
    """Conditional counts / sums per class as columns."""
    v = F.lit(1) if value is None else col_of(value)
    return df.groupBy(*_as_list(by)).agg(
        *[
            F.sum(F.when(F.col(class_col) == F.lit(k), v).otherwise(F.lit(0))).alias(f"{prefix}{k}")
            for k in classes
        ]
    )


def pivot_wide(
    df: DataFrame,
    by,
    pivot_col: str,
    values: Sequence | None,
    measure: Column,
) -> DataFrame:
    """Long to wide (A17).  Pass ``values`` for a fixed schema and no extra job;
    otherwise the distinct values, which become columns, are looked up first."""
    if values is None:
        distinct = df.select(pivot_col).where(F.col(pivot_col).isNotNull()).distinct()
        values = sorted(r[0] for r in distinct.collect())
    return df.groupBy(*_as_list(by)).pivot(pivot_col, list(values)).agg(measure)


def unpivot_long(df: DataFrame, ids, value_cols: Sequence[str], var_name: str = "metric", value_name: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(_as_list(ids), list(value_cols), var_name, value_name)


def prefix_reshape(
    df: DataFrame, ids, prefixes: Sequence[str], variables: Sequence[str], key_name: str = "end", sep: str = "_"
) -> DataFrame:
    """``prefix_var`` column pairs to one row per prefix (A20): unpivot, split, pivot back
    in one ``stack`` projection, keeping the row identity ``ids``."""
    ids = _as_list(ids)
    parts = []
    for p in prefixes:
        parts.append(F.struct(F.lit(p).alias(key_name), *[F.col(f"{p}{sep}{v}").alias(v) for v in variables]))
    return df.select(*ids, F.explode(F.array(*parts)).alias("__r")).select(*ids, "__r.*")


def mean_squared_error(df: DataFrame, actual: str, predicted: str, by=None, name: str = "mse") -> DataFrame:
    """``mean((actual - predicted)^2)``."""
    return df.groupBy(*_as_list(by)).agg(F.avg(F.pow(F.col(actual) - F.col(predicted), 2)).alias(name))


def null_audit(df: DataFrame) -> DataFrame:
    """Null count and rate of every column in one pass, long form."""
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("__rows"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return wide.unpivot("__rows", list(df.columns), "column", "nulls").select(
        "column", "nulls", (F.col("nulls") / F.col("__rows")).alias("null_rate")
    )


def hourly_rollup(df: DataFrame, ts: str, by, measures: Mapping[str, Column], hour_col: str = "hour") -> DataFrame:
    """Group by the timestamp rounded to the nearest hour plus ``by``."""
    return df.groupBy(round_to_hour(ts).alias(hour_col), *_as_list(by)).agg(
        *[c.alias(k) for k, c in measures.items()]
    )


def daily_weekday_counts(df: DataFrame, y: str, m: str, d: str, by, name: str = "n") -> DataFrame:
    """Counts per day and key with the weekday label."""
    day = F.make_date(F.col(y), F.col(m), F.col(d))
    return (
        df.groupBy(day.alias("date"), *_as_list(by))
        .agg(F.count(F.lit(1)).alias(name))
        .withColumn("weekday", F.date_format("date", "E"))
    )


def box_stats(df: DataFrame, by, value: str, coef: float = BOX_WHISKER_IQR) -> DataFrame:
    """Box-plot numbers per group (A25): quartiles, whiskers at the most
    extreme values inside ``coef * IQR`` of the box, and outlier count.

    Everything comes from the distinct (group, value, count) table, so the
    rows are read once; the fences of a group are joined to its values.
    """
    keys = _as_list(by)
    dist = distinct_counts(df.where(F.col(value).isNotNull()), keys, value)
    moments = dist.groupBy(*keys).agg(F.sum("__c").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"))
    quart = percentile_table(df, keys, value, (0.25, 0.5, 0.75), ["q1", "median", "q3"], dist=dist)
    if keys:
        q = null_safe_join(moments, quart, keys)
    else:
        q = moments.withColumns({c: scalar_of(quart, F.col(c)) for c in ("q1", "median", "q3")})
    q = q.select(*keys, "n", "min", "q1", "median", "q3", "max")
    q = q.withColumns({
        "lower_fence": F.col("q1") - F.lit(coef) * (F.col("q3") - F.col("q1")),
        "upper_fence": F.col("q3") + F.lit(coef) * (F.col("q3") - F.col("q1")),
    })
    if keys:
        joined = null_safe_join(dist, q.select(*keys, "lower_fence", "upper_fence"), keys)
    else:
        joined = dist.withColumns({
            "lower_fence": scalar_of(q, F.col("lower_fence")),
            "upper_fence": scalar_of(q, F.col("upper_fence")),
        })
    inside = (F.col(value) >= F.col("lower_fence")) & (F.col(value) <= F.col("upper_fence"))
    w = joined.groupBy(*keys).agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("__c"))).alias("n_outliers"),
    )
    if keys:
        return null_safe_join(q, w, keys)
    return q.withColumns({c: scalar_of(w, F.col(c)) for c in ("whisker_low", "whisker_high", "n_outliers")})


def group_moments(df: DataFrame, by, value: str) -> DataFrame:
    """n, mean and sample variance per group (input of A26)."""
    return df.where(F.col(value).isNotNull()).groupBy(*_as_list(by)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var")
    )


def pairwise_t(df: DataFrame, group: str, value: str) -> DataFrame:
    """Pairwise t statistics with pooled SD over all groups, like ``pairwise.t.test``.

    Only the per-group moments table (one row per group) is paired, which is what
    the test asks for; raw rows are never paired.
    Output: group_a < group_b, t, df (residual degrees of freedom).
    """
    from lodestar.session import reliable_checkpoint

    # one row per group, read four times (pooled variance, degrees of freedom, both pair sides): materialise once
    m = reliable_checkpoint(group_moments(df, group, value))
    pooled_var = scalar_of(m, F.sum((F.col("n") - 1) * F.col("var")) / F.sum(F.col("n") - 1))
    dof = scalar_of(m, F.sum(F.col("n")) - F.count(F.lit(1)))
    a, b = m.alias("a"), m.alias("b")
    pairs = a.join(b, F.col(f"a.{group}") < F.col(f"b.{group}"))
    se = F.sqrt(pooled_var * (F.lit(1.0) / F.col("a.n") + F.lit(1.0) / F.col("b.n")))
    return pairs.select(
        F.col(f"a.{group}").alias("group_a"),
        F.col(f"b.{group}").alias("group_b"),
        (F.col("a.mean") - F.col("b.mean")).alias("diff"),
        F.try_divide(F.col("a.mean") - F.col("b.mean"), se).alias("t"),
        dof.alias("df"),
    )


def holm_adjust(pairs: DataFrame, p_col: str = "p_value", out_col: str = "p_holm") -> DataFrame:
    """Holm step-down adjustment over all rows of a small table of p values
    (the default adjustment of pairwise t tests)."""
    m = scalar_of(pairs, F.count(F.lit(1)))
    order = Window.orderBy(F.col(p_col).asc_nulls_last(), *[F.col(c) for c in pairs.columns if c != p_col])
    step = pairs.withColumn("__i", F.row_number().over(order)).withColumn(
        "__s", F.least(F.lit(1.0), (m - F.col("__i") + F.lit(1)) * F.col(p_col))
    )
    cum = Window.orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    return step.withColumn(out_col, F.max("__s").over(cum)).drop("__i", "__s")


def pairwise_t_tests(df: DataFrame, group: str, value: str) -> DataFrame:
    """``pairwise_t`` plus two-sided p values and Holm-adjusted p values.

    The p values are computed on the pairs table only, never on raw rows.
    """
    from lodestar.functions.distributions import t_p_value

    pairs = pairwise_t(df, group, value).withColumn("p_value", t_p_value("t", "df"))
    return holm_adjust(pairs)


def linear_trend(df: DataFrame, y: str, x: str, by=None) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group: slope, intercept, R², n."""
    return df.groupBy(*_as_list(by)).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def kernel_density(df: DataFrame, value: str, by=None, grid_points: int = 64, bins: int = 512, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on a fixed grid per group.

    Rows are first pre-binned to ``bins`` cells per group (one aggregation),
    so the kernel sum costs ``grid_points * bins`` per group regardless of the
    row count.  Bandwidth defaults to Silverman's rule from the group moments.
    """
    keys = _as_list(by) or []
    data = df.where(F.col(value).isNotNull())
    stats = data.groupBy(*keys).agg(
        F.min(value).alias("__lo"), F.max(value).alias("__hi"),
        F.stddev_samp(value).alias("__sd"), F.count(F.lit(1)).alias("__n"))
    g = null_safe_join(data, stats, keys) if keys else data.withColumns({
        c: scalar_of(data, agg) for c, agg in {
            "__lo": F.min(value), "__hi": F.max(value),
            "__sd": F.stddev_samp(value), "__n": F.count(F.lit(1))}.items()})
    width = F.greatest(F.col("__hi") - F.col("__lo"), F.lit(1e-12))
    binned = g.withColumn("__b", F.least(F.floor((F.col(value) - F.col("__lo")) / width * bins), F.lit(bins - 1))) \
        .groupBy(*keys, "__b", "__lo", "__hi", "__sd", "__n").agg(F.count(F.lit(1)).alias("__c")) \
        .withColumn("__center", F.col("__lo") + (F.col("__b") + 0.5) * width / bins)
    h = F.lit(bandwidth) if bandwidth else F.greatest(
        F.lit(1.06) * F.coalesce(F.col("__sd"), F.lit(0.0)) * F.pow(F.col("__n"), F.lit(-0.2)), F.lit(1e-9))
    grid = binned.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1)))) \
        .withColumn("x", F.col("__lo") + F.col("__i") * (F.col("__hi") - F.col("__lo")) / F.lit(grid_points - 1)) \
        .withColumn("__h", h)
    z = (F.col("x") - F.col("__center")) / F.col("__h")
    return grid.groupBy(*keys, "__i", "x").agg(
        (F.sum(F.col("__c") * F.exp(-0.5 * z * z)) /
         (F.first("__n") * F.first("__h") * F.lit((2 * 3.141592653589793) ** 0.5))).alias("density")
    ).drop("__i")


def distinct_counts(df: DataFrame, keys: list, value: str, count_col: str = "__c") -> DataFrame:
    """Distinct (group, value) pairs with their row counts, materialised once in the
    shared checkpoint folder.  Percentile and rank plans read this table several
    times; a checkpoint keeps the upstream scan and joins from running once per
    reader.  Much smaller than the rows whenever values repeat."""
    from lodestar.session import reliable_checkpoint

    return reliable_checkpoint(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count_col)))


def percentile_table(
    df: DataFrame,
    by,
    value: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    dist: DataFrame | None = None,
    with_moments: bool = False,
) -> DataFrame:
    """Exact interpolated percentiles per group without a per-group merge task.

    Same result as SQL ``percentile`` / ``quantile_cont``: with n rows and
    h = (n - 1) p, the value is x[floor h] + (x[ceil h] - x[floor h]) (h - floor h)
    over the sorted non-NULL values x.  The distinct (group, value) pairs with
    their counts are materialised once and numbered by ``ahead_counts``, whose
    range partitions follow the data; a value that covers a wanted rank is then
    picked by a map-side combined aggregation.  A group with a NULL key is a
    group like any other.  ``with_moments`` adds n (all rows, NULL values
    included) and the mean from the same pass.
    """
    from lodestar.operators.windows import ahead_counts

    keys = _as_list(by)
    names = list(names or [f"p{int(round(p * 100)):02d}" for p in probs])
    v = F.col(value)
    dist = dist if dist is not None else distinct_counts(df, keys, value)
    ranked = ahead_counts(dist.where(v.isNotNull()), keys, value, "__c", descending=False, total_col="__n")
    picks, columns = [], []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        h = (F.col("__n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            covers = (rank >= F.col("__ahead")) & (rank < F.col("__ahead") + F.col("__c"))
            picks.append(F.max(F.when(covers, v)).alias(f"__{side}{i}"))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        columns.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    picked = ranked.groupBy(*keys).agg(F.max("__n").alias("__n"), *picks).select(*keys, *columns)
    if not with_moments:  # a group of NULL values only has NULL percentiles
        return null_safe_join(dist.select(*keys).distinct(), picked, keys, "left") if keys else picked
    moments = dist.groupBy(*keys).agg(
        F.sum("__c").alias("n"),
        F.try_divide(F.sum(v * F.col("__c")), F.sum(F.when(v.isNotNull(), F.col("__c")))).alias("mean"),
    )
    if keys:
        return null_safe_join(moments, picked, keys, "left")
    return moments.withColumns({n: scalar_of(picked, F.col(n)) for n in names})

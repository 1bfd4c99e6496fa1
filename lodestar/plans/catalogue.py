"""Query catalogue: one entry per SURVEY section 2 row that has a runnable form.

Each entry pairs a Spark job over the driver tables (through the stand-ins)
with an ANSI SQL twin for DuckDB.  Every job reads whole tables; parameters
(cut-offs, bins, k) are the operators' own, not row caps.  Results pass
through ``conform`` so both engines emit the same types and rounding.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.defaults import PROFILE_PROBABILITIES as PROBS
from lodestar.functions import scalar as fx
from lodestar.operators import geo, joins, rollups, sampling, setops, verbs, visagg, windows
from lodestar.plans import standins as si
from lodestar.plans.contract import conform, day_text, i8, r4, ts_text

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, tuple[Query, str | None]] = {}


def register(key: str, sql: str | None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return conform(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.job = fn  # the job without the comparison normalisation (used by bench.py)
        CATALOGUE[key] = (run, sql)
        return run

    return deco


W = si.with_sql


def _q(name: str, p: float, col: str) -> str:
    return f"{r4(f'quantile_cont({col}, {p})')} AS {name}"


# ----------------------------------------------------------- V09 / A08
@register(
    "v09_hour_profile",
    "SELECT "
    + i8("hour(ts)")
    + " AS hour, count(*) AS n, "
    + r4("avg(value)")
    + " AS mean, "
    + ", ".join(_q(f"p{int(p * 100):02d}", p, "value") for p in PROBS)
    + " FROM events GROUP BY hour(ts)",
)
def v09_hour_profile(spark, d):
    """Hour-of-day profile: n, mean and five exact percentiles.

    24 groups over the whole table: the distributed exact form keeps the
    percentile work spread over (hour, value) keys instead of 24 merge tasks.
    """
    e = si.table(spark, d, "events").withColumn("hour", F.hour("ts"))
    return rollups.profile(e, "hour", "value", PROBS, method="distributed")


# ---------------------------------------------------------------- A02
@register(
    "a02_group_count",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, {i8('dropoff_gid')} AS dropoff_gid, count(*) AS n "
    "FROM trips GROUP BY pickup_gid, dropoff_gid",
)
def a02_group_count(spark, d):
    """Trips per origin-destination pair."""
    return rollups.group_count(si.trips(spark, d), ["pickup_gid", "dropoff_gid"])


# ---------------------------------------------------------------- A03
@register(
    "a03_weighted_count",
    W(si.TOR_SQL) + f"SELECT {day_text('date')} AS date, {r4('sum(relays)')} AS n FROM tor GROUP BY date",
)
def a03_weighted_count(spark, d):
    """Relays per day: count weighted by ``relays``."""
    return rollups.weighted_count(si.tor_servers(spark, d), "date", "relays")


# ---------------------------------------------------------------- A07
@register(
    "a07_stddev",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, count(*) AS n, {r4('stddev_samp(trip_distance)')} AS sd_distance "
    "FROM trips GROUP BY pickup_gid",
)
def a07_stddev(spark, d):
    """Sample standard deviation of distance per origin."""
    return rollups.summarize(
        si.trips(spark, d), "pickup_gid",
        {"n": F.count(F.lit(1)), "sd_distance": F.stddev_samp("trip_distance")},
    )


# ---------------------------------------------------------------- A09
@register(
    "a09_class_counts",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, "
    + ", ".join(f"{i8(f'sum(CASE WHEN cab_type_id = {chr(39)}{k}{chr(39)} THEN 1 ELSE 0 END)')} AS n_{k}" for k in "ANR")
    + " FROM trips GROUP BY pickup_gid",
)
def a09_class_counts(spark, d):
    """Conditional counts per cab class."""
    return rollups.class_sums(si.trips(spark, d), "pickup_gid", "cab_type_id", ["A", "N", "R"], prefix="n_")


# ---------------------------------------------------------------- A12
_A12_MEASURES_SQL = (
    "count(*) AS n, "
    + f"{r4('avg(trip_distance)')} AS mean_distance, {r4('avg(fare_amount)')} AS mean_fare, "
    + f"{r4('avg(tip_amount)')} AS mean_tip, {r4('avg(total_amount)')} AS mean_total, "
    + f"{r4('stddev_samp(fare_amount)')} AS sd_fare, {r4('min(fare_amount)')} AS min_fare, {r4('max(fare_amount)')} AS max_fare"
)


@register(
    "a12_rollup_grains",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, {i8('dropoff_gid')} AS dropoff_gid, vendor_id, "
    + _A12_MEASURES_SQL
    + ", CASE WHEN grouping(vendor_id) = 0 THEN 'od_vendor' WHEN grouping(dropoff_gid) = 0 THEN 'od' ELSE 'origin' END AS grain "
    "FROM trips GROUP BY GROUPING SETS ((pickup_gid, dropoff_gid, vendor_id), (pickup_gid, dropoff_gid), (pickup_gid))",
)
def a12_rollup_grains(spark, d):
    """The same eight measures at three grains in one scan."""
    return rollups.grain_rollup(
        si.trips(spark, d),
        {
            "od_vendor": ["pickup_gid", "dropoff_gid", "vendor_id"],
            "od": ["pickup_gid", "dropoff_gid"],
            "origin": ["pickup_gid"],
        },
        {
            "n": F.count(F.lit(1)),
            "mean_distance": F.avg("trip_distance"),
            "mean_fare": F.avg("fare_amount"),
            "mean_tip": F.avg("tip_amount"),
            "mean_total": F.avg("total_amount"),
            "sd_fare": F.stddev_samp("fare_amount"),
            "min_fare": F.min("fare_amount"),
            "max_fare": F.max("fare_amount"),
        },
    )


# ---------------------------------------------------------------- A13
@register(
    "a13_having",
    W(si.FLIGHTS_SQL)
    + f"SELECT {i8('origin')} AS origin, {i8('dest')} AS dest, count(*) AS n, {r4('avg(depdelay - arrdelay)')} AS mean_gain "
    "FROM flights GROUP BY origin, dest HAVING count(*) > 100",
)
def a13_having(spark, d):
    """Routes with more than 100 flights and their mean gain."""
    f = si.flights(spark, d)
    return rollups.summarize(
        f, ["origin", "dest"], {"n": F.count(F.lit(1)), "mean_gain": F.avg(F.col("depdelay") - F.col("arrdelay"))}
    ).where(F.col("n") > 100)


# ---------------------------------------------------------------- A14
@register(
    "a14_regroup",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, count(*) AS n_groups, {r4('avg(mean_fare)')} AS mean_of_yearly_means "
    "FROM (SELECT pickup_gid, year(pickup_datetime) AS y, avg(fare_amount) AS mean_fare FROM trips GROUP BY 1, 2) "
    "GROUP BY pickup_gid",
)
def a14_regroup(spark, d):
    """Mean fare per origin and year, then the unweighted mean of those means."""
    t = si.trips(spark, d).withColumn("y", F.year("pickup_datetime"))
    return rollups.regroup_mean(t, ["pickup_gid", "y"], "pickup_gid", "fare_amount", "mean_fare", "mean_of_yearly_means")


# ---------------------------------------------------------------- A15
@register(
    "a15_weighted_mean",
    W(si.BABYNAMES_SQL)
    + "SELECT name, CAST(floor(sum(year * n) / sum(n) + 0.5) AS BIGINT) AS mean_year FROM babynames GROUP BY name",
)
def a15_weighted_mean(spark, d):
    """Count-weighted mean year per name, rounded."""
    return rollups.weighted_mean(si.babynames(spark, d), "name", "year", "n", "mean_year", digits=0)


# ---------------------------------------------------------------- A16
@register(
    "a16_ratio",
    W(si.TRIPS_SQL)
    + f"SELECT payment_type, {r4('avg(tip_amount)')} AS mean_tip_pct_num, {r4('avg(fare_amount)')} AS mean_tip_pct_den, "
    + f"{r4('avg(tip_amount) / avg(fare_amount)')} AS tip_pct FROM trips GROUP BY payment_type",
)
def a16_ratio(spark, d):
    """Tip share by payment type: ratio of two means."""
    return rollups.ratio_of_means(si.trips(spark, d), "payment_type", "tip_amount", "fare_amount", "tip_pct")


# ---------------------------------------------------------------- A17
PLATFORMS = ["click", "error", "purchase", "signup", "view"]


@register(
    "a17_pivot_daily",
    W(si.TOR_SQL)
    + f"SELECT {day_text('date')} AS date, "
    + ", ".join(f"{r4(f'sum(CASE WHEN platform = {chr(39)}{p}{chr(39)} THEN relays END)')} AS {p}" for p in PLATFORMS)
    + " FROM tor GROUP BY date",
)
def a17_pivot_daily(spark, d):
    """Relays per day, one column per platform."""
    return rollups.pivot_wide(si.tor_servers(spark, d), "date", "platform", PLATFORMS, F.sum("relays"))


# ---------------------------------------------------------------- A19
@register(
    "a19_unpivot",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, metric, {r4('value')} AS value FROM ("
    "SELECT pickup_gid, avg(fare_amount) AS mean_fare, avg(tip_amount) AS mean_tip, avg(trip_distance) AS mean_distance "
    "FROM trips GROUP BY pickup_gid) UNPIVOT (value FOR metric IN (mean_fare, mean_tip, mean_distance))",
)
def a19_unpivot(spark, d):
    """Wide per-origin means to (origin, metric, value) rows."""
    wide = rollups.summarize(
        si.trips(spark, d), "pickup_gid",
        {"mean_fare": F.avg("fare_amount"), "mean_tip": F.avg("tip_amount"), "mean_distance": F.avg("trip_distance")},
    )
    return rollups.unpivot_long(wide, "pickup_gid", ["mean_fare", "mean_tip", "mean_distance"])


# ---------------------------------------------------------------- A20
@register(
    "a20_prefix_reshape",
    W(si.FLIGHTS_SQL, si.AIRPORTS_SQL)
    + f"SELECT {i8('origin')} AS origin, {i8('dest')} AS dest, e AS \"end\", {r4('lat')} AS lat, {r4('lon')} AS lon FROM ("
    "SELECT r.origin, r.dest, 'origin' AS e, a.lat, a.lon FROM (SELECT DISTINCT origin, dest FROM flights) r JOIN airports a ON r.origin = a.faa "
    "UNION ALL SELECT r.origin, r.dest, 'dest' AS e, b.lat, b.lon FROM (SELECT DISTINCT origin, dest FROM flights) r JOIN airports b ON r.dest = b.faa)",
)
def a20_prefix_reshape(spark, d):
    """origin_/dest_ coordinate pairs of each route to one row per end."""
    routes = si.flights(spark, d).select("origin", "dest").distinct()
    ends = geo.route_ends(routes, si.airports(spark, d), "origin", "dest", "faa")
    wide = ends.select(
        "origin", "dest",
        F.col("lat1").alias("origin_lat"), F.col("lon1").alias("origin_lon"),
        F.col("lat2").alias("dest_lat"), F.col("lon2").alias("dest_lon"),
    )
    return rollups.prefix_reshape(wide, ["origin", "dest"], ["origin", "dest"], ["lat", "lon"], key_name="end")


# ---------------------------------------------------------------- A23
@register(
    "a23_round_hour",
    f"SELECT {ts_text('h')} AS hour, event_type, count(*) AS n, {r4('avg(value)')} AS mean_value, {r4('max(value)')} AS max_value "
    "FROM (SELECT date_trunc('hour', ts + INTERVAL 30 MINUTE) AS h, event_type, value FROM events) GROUP BY h, event_type",
)
def a23_round_hour(spark, d):
    """Events rounded to the nearest hour, per type: n, mean, max."""
    return rollups.hourly_rollup(
        si.table(spark, d, "events"), "ts", "event_type",
        {"n": F.count(F.lit(1)), "mean_value": F.avg("value"), "max_value": F.max("value")},
    )


# ---------------------------------------------------------------- A24
@register(
    "a24_weekday",
    W(si.FLIGHTS_SQL)
    + f"SELECT {day_text('dt')} AS date, {i8('dest')} AS dest, count(*) AS n, strftime(dt, '%a') AS weekday "
    "FROM (SELECT make_date(year, month, dayofmonth) AS dt, dest FROM flights) GROUP BY dt, dest",
)
def a24_weekday(spark, d):
    """Daily flights per destination with weekday label."""
    return rollups.daily_weekday_counts(si.flights(spark, d), "year", "month", "dayofmonth", "dest")


# ---------------------------------------------------------------- A25
@register(
    "a25_box_stats",
    "WITH q AS (SELECT event_type, count(*) AS n, min(value) AS mn, max(value) AS mx, "
    "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3 "
    "FROM events WHERE value IS NOT NULL GROUP BY event_type), "
    "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q), "
    "w AS (SELECT e.event_type, min(CASE WHEN e.value >= f.lf AND e.value <= f.uf THEN e.value END) AS wl, "
    "max(CASE WHEN e.value >= f.lf AND e.value <= f.uf THEN e.value END) AS wh, "
    "sum(CASE WHEN e.value >= f.lf AND e.value <= f.uf THEN 0 ELSE 1 END) AS nout "
    "FROM events e JOIN f ON e.event_type = f.event_type WHERE e.value IS NOT NULL GROUP BY e.event_type) "
    f"SELECT f.event_type, f.n, {r4('f.mn')} AS min, {r4('f.q1')} AS q1, {r4('f.med')} AS median, {r4('f.q3')} AS q3, "
    f"{r4('f.mx')} AS max, {r4('f.lf')} AS lower_fence, {r4('f.uf')} AS upper_fence, {r4('w.wl')} AS whisker_low, "
    f"{r4('w.wh')} AS whisker_high, {i8('w.nout')} AS n_outliers FROM f JOIN w ON f.event_type = w.event_type",
)
def a25_box_stats(spark, d):
    """Box-plot numbers of event value per type."""
    return rollups.box_stats(si.table(spark, d, "events"), "event_type", "value")


# ---------------------------------------------------------------- A26
@register(
    "a26_pairwise_t",
    W(si.FLIGHTS_SQL)
    + ", m AS (SELECT uniquecarrier AS g, count(*) AS n, avg(depdelay) AS mean, var_samp(depdelay) AS v FROM flights GROUP BY 1), "
    "p AS (SELECT sum((n - 1) * v) / sum(n - 1) AS pv, sum(n) - count(*) AS dof FROM m) "
    f"SELECT a.g AS group_a, b.g AS group_b, {r4('a.mean - b.mean')} AS diff, "
    f"{r4('(a.mean - b.mean) / sqrt(p.pv * (1.0 / a.n + 1.0 / b.n))')} AS t, {i8('p.dof')} AS df "
    "FROM m a JOIN m b ON a.g < b.g CROSS JOIN p",
)
def a26_pairwise_t(spark, d):
    """Pairwise t statistics of delay between carriers, pooled SD."""
    return rollups.pairwise_t(si.flights(spark, d), "uniquecarrier", "depdelay")


# ---------------------------------------------------------------- A27
@register(
    "a27_trend",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, {r4('regr_slope(fare_amount, trip_distance)')} AS slope, "
    f"{r4('regr_intercept(fare_amount, trip_distance)')} AS intercept, {r4('regr_r2(fare_amount, trip_distance)')} AS r2, "
    f"{i8('regr_count(fare_amount, trip_distance)')} AS n FROM trips GROUP BY pickup_gid",
)
def a27_trend(spark, d):
    """Linear trend of fare on distance per origin."""
    return rollups.linear_trend(si.trips(spark, d), "fare_amount", "trip_distance", "pickup_gid")


# ---------------------------------------------------------------- P10
@register(
    "p10_in_list",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('order_id')} AS order_id, payment_type, cab_type_id, {r4('fare_amount')} AS fare_amount FROM trips "
    "WHERE lower(payment_type) IN ('1-urgent', '2-high') AND cab_type_id IN ('A', 'R')",
)
def p10_in_list(spark, d):
    """IN lists, one after ``lower`` (P10)."""
    t = verbs.in_list(si.trips(spark, d), "payment_type", ["1-urgent", "2-high"], lower=True)
    return verbs.in_list(t, "cab_type_id", ["A", "R"]).select("order_id", "payment_type", "cab_type_id", "fare_amount")


# ---------------------------------------------------------------- P12
@register(
    "p12_ranges",
    W(si.FLIGHTS_SQL)
    + f"SELECT {i8('year')} AS year, uniquecarrier, {i8('tailnum')} AS tailnum, {r4('depdelay')} AS depdelay FROM flights "
    "WHERE depdelay > 15 AND depdelay < 40 AND year >= 1996 AND year <= 1999",
)
def p12_ranges(spark, d):
    """Open interval on delay, closed interval on year."""
    f = verbs.where_all(
        si.flights(spark, d), fx.strict_between("depdelay", 15, 40), F.col("year").between(1996, 1999)
    )
    return f.select("year", "uniquecarrier", "tailnum", "depdelay")


# ---------------------------------------------------------------- P15
@register(
    "p15_freq_keys",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('dropoff_gid')} AS dropoff_gid, count(*) AS n FROM trips WHERE dropoff_gid IS NOT NULL "
    "GROUP BY dropoff_gid HAVING count(*) > 2400",
)
def p15_freq_keys(spark, d):
    """Destination keys seen more than 2400 times."""
    return verbs.frequent_keys(si.trips(spark, d), "dropoff_gid", 2400)


# ---------------------------------------------------------------- P21
@register(
    "p21_brush",
    f"SELECT {i8('p_partkey')} AS p_partkey, {i8('p_size')} AS p_size, {r4('p_retailprice')} AS p_retailprice FROM part "
    "WHERE p_size BETWEEN 10 AND 20 AND p_retailprice BETWEEN 920 AND 960",
)
def p21_brush(spark, d):
    """Rectangle selection on (size, price)."""
    p = si.table(spark, d, "part")
    return verbs.brush(p, "p_size", "p_retailprice", 10, 20, 920, 960).select("p_partkey", "p_size", "p_retailprice")


# ---------------------------------------------------------------- P23
@register(
    "p23_recode",
    f"SELECT {i8('o_orderkey')} AS o_orderkey, o_orderpriority, "
    "CASE WHEN lower(trim(o_orderpriority)) IN ('1-urgent', '2-high') THEN 'credit' "
    "WHEN lower(trim(o_orderpriority)) IN ('3-medium') THEN 'cash' ELSE 'unk' END AS pay_type FROM orders",
)
def p23_recode(spark, d):
    """Priority codes normalised to credit / cash / unk."""
    o = si.table(spark, d, "orders")
    return o.select(
        "o_orderkey", "o_orderpriority",
        verbs.normalise_codes("o_orderpriority", {"credit": ["1-URGENT", "2-HIGH"], "cash": ["3-MEDIUM"]}).alias("pay_type"),
    )


# ---------------------------------------------------------------- J01
@register(
    "j01_left",
    W(si.FLIGHTS_SQL, si.AIRLINES_SQL)
    + f"SELECT {i8('f.tailnum')} AS tailnum, f.uniquecarrier, a.description, {r4('f.depdelay')} AS depdelay "
    "FROM flights f LEFT JOIN airlines a ON f.uniquecarrier = a.code",
)
def j01_left(spark, d):
    """Flights left join carriers on differently named keys."""
    f = si.flights(spark, d)
    out = joins.lookup_join(f, si.airlines(spark, d), {"uniquecarrier": "code"}, how="left")
    return out.select("tailnum", "uniquecarrier", "description", "depdelay")


# ---------------------------------------------------------------- J02
@register(
    "j02_role_join",
    W(si.TRIPS_SQL, si.NYCT_SQL)
    + f"SELECT {i8('t.order_id')} AS order_id, {i8('t.pickup_gid')} AS pickup_gid, p.ntaname AS pickup_nta, p.boroname AS pickup_boro, "
    f"{i8('t.dropoff_gid')} AS dropoff_gid, q.ntaname AS dropoff_nta, q.boroname AS dropoff_boro, {r4('t.fare_amount')} AS fare_amount "
    "FROM trips t LEFT JOIN nyct p ON t.pickup_gid = p.gid LEFT JOIN nyct q ON t.dropoff_gid = q.gid",
)
def j02_role_join(spark, d):
    """The area lookup joined twice, as pickup and as dropoff."""
    t = si.trips(spark, d).select("order_id", "pickup_gid", "dropoff_gid", "fare_amount")
    out = joins.role_join(
        t, si.nyct(spark, d), "gid",
        {"pickup": "pickup_gid", "dropoff": "dropoff_gid"}, {"ntaname": "nta", "boroname": "boro"},
    )
    return out.select("order_id", "pickup_gid", "pickup_nta", "pickup_boro", "dropoff_gid", "dropoff_nta", "dropoff_boro", "fare_amount")


# ---------------------------------------------------------------- J03
@register(
    "j03_inner",
    f"SELECT {i8('o.o_orderkey')} AS o_orderkey, c.c_name, c.c_mktsegment, {r4('o.o_totalprice')} AS o_totalprice "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
)
def j03_inner(spark, d):
    """Orders inner join customers on an explicit key."""
    o = si.table(spark, d, "orders")
    c = si.table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return o.join(c, on="o_custkey", how="inner").select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice")


# ---------------------------------------------------------------- J04
@register(
    "j04_natural",
    "SELECT n_name, r_name, count(*) AS n_suppliers FROM supplier s JOIN "
    "(SELECT n_nationkey AS s_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) x "
    "ON s.s_nationkey = x.s_nationkey GROUP BY n_name, r_name",
)
def j04_natural(spark, d):
    """Natural joins on the shared column names."""
    n = si.table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    nr = joins.natural_join(n, si.table(spark, d, "region")).withColumnRenamed("n_nationkey", "s_nationkey")
    s = joins.natural_join(si.table(spark, d, "supplier"), nr.select("s_nationkey", "n_name", "r_name"))
    return rollups.group_count(s, ["n_name", "r_name"], "n_suppliers")


# ---------------------------------------------------------------- J05
_TOP_NAMES_SQL = (
    ", tot AS (SELECT sex, name, sum(n) AS total FROM babynames GROUP BY sex, name), "
    "top AS (SELECT sex, name FROM (SELECT sex, name, rank() OVER (PARTITION BY sex ORDER BY total DESC) AS rk FROM tot) WHERE rk <= 4) "
)


@register(
    "j05_semi",
    W(si.BABYNAMES_SQL)
    + _TOP_NAMES_SQL
    + f"SELECT {i8('b.year')} AS year, b.sex, b.name, {r4('sum(b.n)')} AS total FROM babynames b "
    "WHERE EXISTS (SELECT 1 FROM top t WHERE t.sex = b.sex AND t.name = b.name) GROUP BY b.year, b.sex, b.name",
)
def j05_semi(spark, d):
    """Yearly totals of the top four names per sex: semi join on the qualifying keys."""
    b = si.babynames(spark, d)
    tot = rollups.summarize(b, ["sex", "name"], {"total": F.sum("n")})
    top = windows.top_k_with_ties(tot, "total", 4, by="sex").select("sex", "name")
    return rollups.summarize(joins.semi_join(b, top, ["sex", "name"]), ["year", "sex", "name"], {"total": F.sum("n")})


# ---------------------------------------------------------------- J06
@register(
    "j06_fill_bins",
    "WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders "
    "WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000 GROUP BY 1), "
    "all_m AS (SELECT unnest(generate_series((SELECT min(date_trunc('month', o_orderdate)) FROM orders), "
    "(SELECT max(date_trunc('month', o_orderdate)) FROM orders), INTERVAL 1 MONTH)) AS month) "
    f"SELECT {day_text('a.month')} AS month, {i8('coalesce(m.n, 0)')} AS n FROM all_m a LEFT JOIN m ON a.month = m.month",
)
def j06_fill_bins(spark, d):
    """Monthly counts of large urgent orders over the complete month range, empty months as 0."""
    o = si.table(spark, d, "orders").withColumn("month", F.trunc(F.to_date("o_orderdate"), "month"))
    counts = rollups.group_count(
        o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000)), "month"
    )
    lo, hi = fx.scalar_of(o, F.min("month")), fx.scalar_of(o, F.max("month"))
    months = spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return months.join(F.broadcast(counts), "month", "left").select(
        "month", F.coalesce(F.col("n"), F.lit(0)).alias("n")
    )


# ---------------------------------------------------------------- J07
@register(
    "j07_semi_anti",
    "WITH k AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R') "
    f"SELECT {i8('s_suppkey')} AS s_suppkey, s_name, 'semi' AS tag FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM k) "
    f"UNION ALL SELECT {i8('s_suppkey')} AS s_suppkey, s_name, 'anti' AS tag FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM k)",
)
def j07_semi_anti(spark, d):
    """Suppliers with / without a full-quantity returned line."""
    s = si.table(spark, d, "supplier").select("s_suppkey", "s_name")
    k = (
        si.table(spark, d, "lineitem")
        .where((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R"))
        .select(F.col("l_suppkey").alias("s_suppkey"))
    )
    return setops.tagged_union(
        {"semi": joins.semi_join(s, k, "s_suppkey"), "anti": joins.anti_join(s, k, "s_suppkey")}, "tag"
    )


# ---------------------------------------------------------------- W01
_OD_COUNTS = "SELECT pickup_gid, dropoff_gid, count(*) AS n FROM trips GROUP BY pickup_gid, dropoff_gid"


@register(
    "w01_topk_ties",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('pickup_gid')} AS pickup_gid, {i8('dropoff_gid')} AS dropoff_gid, n, {i8('rk')} AS rank FROM ("
    f"SELECT *, rank() OVER (ORDER BY n DESC) AS rk FROM ({_OD_COUNTS})) WHERE rk <= 25",
)
def w01_topk_ties(spark, d):
    """Top 25 origin-destination pairs by trips, ties at the cut kept."""
    c = rollups.group_count(si.trips(spark, d), ["pickup_gid", "dropoff_gid"])
    return windows.top_k_with_ties(c, "n", 25)


# ---------------------------------------------------------------- W02
@register(
    "w02_topk_partition",
    W(si.BABYNAMES_SQL)
    + ", tot AS (SELECT sex, name, sum(n) AS total FROM babynames GROUP BY sex, name) "
    f"SELECT sex, name, {r4('total')} AS total, {i8('rk')} AS rank FROM ("
    "SELECT *, rank() OVER (PARTITION BY sex ORDER BY total DESC) AS rk FROM tot) WHERE rk < 5",
)
def w02_topk_partition(spark, d):
    """Names with rank < 5 by total per sex."""
    tot = rollups.summarize(si.babynames(spark, d), ["sex", "name"], {"total": F.sum("n")})
    return windows.top_k_with_ties(tot, "total", 4, by="sex")


# ---------------------------------------------------------------- W03
@register(
    "w03_rank",
    W(si.FLIGHTS_SQL)
    + f"SELECT {i8('year')} AS year, {i8('month')} AS month, {i8('dayofmonth')} AS dayofmonth, {i8('tailnum')} AS tailnum, "
    f"{r4('depdelay')} AS depdelay, {i8('rank() OVER (PARTITION BY year, month, dayofmonth ORDER BY depdelay DESC)')} AS rank FROM flights",
)
def w03_rank(spark, d):
    """Rank of each flight's delay within its day."""
    f = si.flights(spark, d).select("year", "month", "dayofmonth", "tailnum", "depdelay")
    return windows.rank_within(f, "depdelay", by=["year", "month", "dayofmonth"])


# ---------------------------------------------------------------- W04
@register(
    "w04_extremes",
    W(si.FLIGHTS_SQL)
    + f"SELECT uniquecarrier, {i8('tailnum')} AS tailnum, {r4('arrdelay')} AS arrdelay FROM ("
    "SELECT uniquecarrier, tailnum, arrdelay, min(arrdelay) OVER (PARTITION BY uniquecarrier) AS lo, "
    "max(arrdelay) OVER (PARTITION BY uniquecarrier) AS hi FROM flights) WHERE arrdelay = lo OR arrdelay = hi",
)
def w04_extremes(spark, d):
    """Flights at their carrier's minimum or maximum delay."""
    f = si.flights(spark, d).select("uniquecarrier", "tailnum", "arrdelay")
    return windows.extremes(f, "arrdelay", by="uniquecarrier")


# ---------------------------------------------------------------- W05
@register(
    "w05_ntile",
    f"SELECT {i8('o_orderkey')} AS o_orderkey, {r4('o_totalprice')} AS o_totalprice, "
    f"{i8('ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey)')} AS decile FROM orders",
)
def w05_ntile(spark, d):
    """Deciles of order value, numbered globally without a single-partition window."""
    o = si.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return windows.ntile(o, 10, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()], "decile")


# ---------------------------------------------------------------- W06 / W07
@register(
    "w06_share_cumsum",
    "WITH t AS (SELECT o_totalprice, ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS decile FROM orders), "
    "g AS (SELECT decile, sum(o_totalprice) AS revenue FROM t GROUP BY decile), "
    "s AS (SELECT decile, revenue, revenue / (SELECT sum(revenue) FROM g) AS prop FROM g) "
    f"SELECT {i8('decile')} AS decile, {r4('revenue')} AS revenue, {r4('prop')} AS prop, "
    f"{r4('sum(prop) OVER (ORDER BY decile ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS cum_prop "
    "FROM s",
)
def w06_share_cumsum(spark, d):
    """Revenue share of each order-value decile and its running total."""
    o = si.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    t = windows.ntile(o, 10, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()], "decile")
    g = rollups.summarize(t, "decile", {"revenue": F.sum("o_totalprice")})
    g = windows.share_of_total(g, "revenue", "prop")
    return windows.cumulative_sum(g, [F.col("decile")], "prop", "cum_prop")


# ---------------------------------------------------------------- W08
@register(
    "w08_impute_mean",
    W(si.TITANIC_SQL)
    + f"SELECT {i8('doc_id')} AS doc_id, {r4('coalesce(quality, (SELECT avg(quality) FROM titanic))')} AS quality FROM titanic",
)
def w08_impute_mean(spark, d):
    """Missing quality labels filled with the overall mean."""
    t = si.titanic(spark, d).select("doc_id", F.col("quality").cast("double").alias("quality"))
    return windows.impute_mean(t, "quality")


# ---------------------------------------------------------------- W09 / W10
@register(
    "w09_rescale",
    f"SELECT {i8('p_partkey')} AS p_partkey, "
    f"{r4('(p_retailprice - (SELECT min(p_retailprice) FROM part)) / ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part))')} AS scaled "
    "FROM part",
)
def w09_rescale(spark, d):
    """Price rescaled to [0, 1] with whole-table min and max."""
    p = si.table(spark, d, "part").select("p_partkey", "p_retailprice")
    return windows.rescale_min_max(p, "p_retailprice", "scaled").select("p_partkey", "scaled")


# ---------------------------------------------------------------- U01
@register(
    "u01_tagged_union",
    f"SELECT data, count(*) AS n, {r4('avg(o_totalprice)')} AS mean_price FROM ("
    "SELECT 'train' AS data, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0 "
    "UNION ALL SELECT 'valid' AS data, o_totalprice FROM orders WHERE o_orderkey % 5 = 0) GROUP BY data",
)
def u01_tagged_union(spark, d):
    """Train / validation parts appended with a source tag, then summarised."""
    o = si.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    parts = {"train": o.where(F.col("o_orderkey") % 5 != 0), "valid": o.where(F.col("o_orderkey") % 5 == 0)}
    u = setops.tagged_union(parts, "data")
    return rollups.summarize(u, "data", {"n": F.count(F.lit(1)), "mean_price": F.avg("o_totalprice")})


# ---------------------------------------------------------------- U03
_U03_A = "SELECT s_nationkey AS nationkey FROM supplier WHERE s_acctbal > 5000"
_U03_B = "SELECT c_nationkey AS nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000"


@register(
    "u03_setops",
    f"SELECT 'union' AS op, {i8('nationkey')} AS nationkey FROM ({_U03_A} UNION {_U03_B}) "
    f"UNION ALL SELECT 'intersect', {i8('nationkey')} FROM ({_U03_A} INTERSECT {_U03_B}) "
    f"UNION ALL SELECT 'except', {i8('nationkey')} FROM ({_U03_A} EXCEPT {_U03_B})",
)
def u03_setops(spark, d):
    """Union, intersection and difference of two key sets."""
    a = si.table(spark, d, "supplier").where(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("nationkey"))
    b = (
        si.table(spark, d, "customer")
        .where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000))
        .select(F.col("c_nationkey").alias("nationkey"))
    )
    return setops.tagged_union(
        {
            "union": setops.union_distinct(a, b),
            "intersect": setops.intersect_rows(a, b),
            "except": setops.except_rows(a, b),
        },
        "op",
    )


# ---------------------------------------------------------------- F01 / F02 / F08
@register(
    "f02_math",
    f"SELECT {i8('p_partkey')} AS p_partkey, {r4('abs(p_retailprice - 950)')} AS abs_dev, {i8('ceil(p_retailprice / 7)')} AS ceil7, "
    f"{i8('floor(p_retailprice / 7)')} AS floor7, {r4('sqrt(p_retailprice)')} AS sqrt_price, {r4('log10(p_retailprice)')} AS log10_price, "
    f"{r4('ln(p_retailprice)')} AS ln_price, {r4('exp(p_size / 50.0)')} AS exp_size, {r4('sin(p_size)')} AS sin_size, "
    f"{r4('cos(p_size)')} AS cos_size, {r4('atan2(p_size, 25)')} AS atan2_size, {i8('sign(p_size - 25)')} AS sign_size, "
    f"{r4('pow(p_size, 2)')} AS size_sq, {i8('((p_size - 25) % 7 + 7) % 7')} AS rmod7, {i8('(p_size - 25) % 7')} AS mod7, "
    f"{r4('p_retailprice / 3')} AS third FROM part",
)
def f02_math(spark, d):
    """Arithmetic and math functions, R-style and SQL-style modulo."""
    p = si.table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.abs(F.col("p_retailprice") - 950).alias("abs_dev"),
        F.ceil(F.col("p_retailprice") / 7).alias("ceil7"),
        F.floor(F.col("p_retailprice") / 7).alias("floor7"),
        F.sqrt("p_retailprice").alias("sqrt_price"),
        F.log10("p_retailprice").alias("log10_price"),
        F.log("p_retailprice").alias("ln_price"),
        F.exp(F.col("p_size") / 50.0).alias("exp_size"),
        F.sin("p_size").alias("sin_size"),
        F.cos("p_size").alias("cos_size"),
        F.atan2(F.col("p_size").cast("double"), F.lit(25.0)).alias("atan2_size"),
        F.signum(F.col("p_size") - 25).alias("sign_size"),
        F.pow("p_size", 2).alias("size_sq"),
        fx.r_mod(F.col("p_size") - 25, F.lit(7)).alias("rmod7"),
        ((F.col("p_size") - 25) % 7).alias("mod7"),
        (F.col("p_retailprice") / 3).alias("third"),
    )


# ---------------------------------------------------------------- F14 / F15 / F19
@register(
    "f14_dates",
    W(si.TRIPS_SQL)
    + f"SELECT {i8('order_id')} AS order_id, {i8('year(pickup_datetime)')} AS pickup_year, {i8('week(pickup_datetime)')} AS pickup_week, "
    f"{i8('hour(dropoff_datetime)')} AS dropoff_hour, {i8('floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))')} AS trip_seconds, "
    f"{r4('(floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60')} AS trip_minutes, strftime(pickup_datetime, '%a') AS pickup_wday "
    "FROM trips",
)
def f14_dates(spark, d):
    """Year, ISO week, hour, epoch-second differences and weekday label."""
    t = si.trips(spark, d)
    return t.select(
        "order_id",
        F.year("pickup_datetime").alias("pickup_year"),
        F.weekofyear("pickup_datetime").alias("pickup_week"),
        F.hour("dropoff_datetime").alias("dropoff_hour"),
        fx.seconds_between("pickup_datetime", "dropoff_datetime").alias("trip_seconds"),
        fx.minutes_between("pickup_datetime", "dropoff_datetime").alias("trip_minutes"),
        fx.weekday_label("pickup_datetime").alias("pickup_wday"),
    )


# ---------------------------------------------------------------- V01
def _hist_sql(src: str, col: str, bins: int) -> str:
    return (
        f", hd AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL), "
        f"hs AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM hd), "
        f"hc AS (SELECT CAST(CASE WHEN hs.w = 0 THEN 0 ELSE least(floor((x - hs.lo) / hs.w), {bins - 1}) END AS BIGINT) AS bin, count(*) AS n "
        "FROM hd, hs GROUP BY 1) "
        f"SELECT b.range AS bin, {i8('coalesce(hc.n, 0)')} AS count, {r4('hs.lo + b.range * hs.w')} AS bin_floor "
        f"FROM range({bins}) b CROSS JOIN hs LEFT JOIN hc ON b.range = hc.bin"
    )


@register("v01_histogram", W(si.TRIPS_SQL) + _hist_sql("trips", "fare_amount", 30))
def v01_histogram(spark, d):
    """30-bin histogram of fare with empty bins filled."""
    return visagg.histogram(si.trips(spark, d), "fare_amount", 30)


# ---------------------------------------------------------------- V02 / V03
def _raster_sql(src: str, x: str, y: str, res: int, facet: str | None = None) -> str:
    g = f"{facet} AS g, " if facet else ""
    gsel = "g, " if facet else ""
    cell = "CASE WHEN rs.max_{a} - rs.min_{a} = 0 THEN 0 ELSE floor(({a} - rs.min_{a}) / (rs.max_{a} - rs.min_{a}) * {res} + 0.5) END"
    return (
        f", rd AS (SELECT {g}{x} AS x, {y} AS y FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL), "
        "rs AS (SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM rd), "
        f"rc AS (SELECT {gsel}{i8(cell.format(a='x', res=res))} AS res_x, {i8(cell.format(a='y', res=res))} AS res_y FROM rd, rs) "
        f"SELECT {gsel}res_x, res_y, count(*) AS n, {r4('min(rs.min_x)')} AS min_x, {r4('min(rs.max_x)')} AS max_x, "
        f"{r4('min(rs.min_y)')} AS min_y, {r4('min(rs.max_y)')} AS max_y FROM rc, rs GROUP BY {gsel}res_x, res_y"
    )


@register("v02_raster", W(si.TRIPS_SQL) + _raster_sql("trips", "fare_amount", "tip_amount", 300))
def v02_raster(spark, d):
    """300 x 300 raster of fare against tip with the global limits."""
    return visagg.raster(si.trips(spark, d), "fare_amount", "tip_amount", 300)


@register(
    "v03_raster_facet",
    W(si.TRIPS_SQL) + _raster_sql("trips", "fare_amount", "trip_distance", 100, facet="vendor_id"),
)
def v03_raster_facet(spark, d):
    """100 x 100 raster per vendor; limits shared by all facets."""
    return visagg.raster(si.trips(spark, d), "fare_amount", "trip_distance", 100, facet="vendor_id")


# ---------------------------------------------------------------- V04 / V05 / V06 / V07
@register(
    "v04_tiles",
    W(si.TRIPS_SQL)
    + ", rd AS (SELECT fare_amount AS x, trip_distance AS y FROM trips WHERE fare_amount IS NOT NULL AND trip_distance IS NOT NULL), "
    "rs AS (SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM rd), "
    "rc AS (SELECT CAST(CASE WHEN rs.max_x - rs.min_x = 0 THEN 0 ELSE floor((x - rs.min_x) / (rs.max_x - rs.min_x) * 500 + 0.5) END AS BIGINT) AS res_x, "
    "CAST(CASE WHEN rs.max_y - rs.min_y = 0 THEN 0 ELSE floor((y - rs.min_y) / (rs.max_y - rs.min_y) * 500 + 0.5) END AS BIGINT) AS res_y FROM rd, rs), "
    "cells AS (SELECT res_x, res_y, count(*) AS freq FROM rc GROUP BY res_x, res_y) "
    f"SELECT res_x, res_y, freq, {r4('floor(freq / (SELECT max(freq) FROM cells) * 100 + 0.5) / 100')} AS alpha FROM cells",
)
def v04_tiles(spark, d):
    """500-cell tiles of fare against distance with relative frequency."""
    return visagg.tiles(si.trips(spark, d), "fare_amount", "trip_distance", 500)


@register(
    "v05_boxbin",
    W(si.TRIPS_SQL)
    + ", rd AS (SELECT fare_amount AS x, trip_distance AS y, total_amount AS c FROM trips WHERE fare_amount IS NOT NULL AND trip_distance IS NOT NULL), "
    "rs AS (SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, max(c) AS max_c FROM rd), "
    "rc AS (SELECT CAST(CASE WHEN rs.max_x - rs.min_x = 0 THEN 0 ELSE floor((x - rs.min_x) / (rs.max_x - rs.min_x) * 100 + 0.5) END AS BIGINT) AS res_x, "
    "CAST(CASE WHEN rs.max_y - rs.min_y = 0 THEN 0 ELSE floor((y - rs.min_y) / (rs.max_y - rs.min_y) * 100 + 0.5) END AS BIGINT) AS res_y, c FROM rd, rs) "
    f"SELECT res_x, res_y, {r4('floor(avg(c) / (SELECT max_c FROM rs) * 100 + 0.5) / 100')} AS res_color FROM rc GROUP BY res_x, res_y",
)
def v05_boxbin(spark, d):
    """100-cell raster coloured by mean total over the largest total."""
    return visagg.boxbin(si.trips(spark, d), "fare_amount", "trip_distance", color="total_amount", resolution=100)


@register(
    "v06_quick_hist",
    W(si.TRIPS_SQL)
    + ", hd AS (SELECT CAST(tip_amount AS DOUBLE) AS x FROM trips WHERE tip_amount IS NOT NULL), "
    "hw AS (SELECT max(x) / 29 AS w FROM hd) "
    f"SELECT {i8('CASE WHEN hw.w = 0 THEN 0 ELSE floor(x / hw.w + 0.5) END')} AS bucket, {r4('max(x)')} AS top, {r4('min(x)')} AS bottom, "
    "count(*) AS count FROM hd, hw GROUP BY 1",
)
def v06_quick_hist(spark, d):
    """Quick histogram of tip: 30 breaks from 0 to max, observed top / bottom per bucket."""
    return visagg.quick_histogram(si.trips(spark, d), "tip_amount", 30)


@register(
    "v07_point_freq",
    W(si.FLIGHTS_SQL) + f"SELECT {r4('depdelay')} AS x, {r4('arrdelay')} AS y, count(*) AS n FROM flights GROUP BY depdelay, arrdelay",
)
def v07_point_freq(spark, d):
    """Exact (x, y, n) point counts of the two delays."""
    return visagg.point_frequency(si.flights(spark, d), "depdelay", "arrdelay")


# ---------------------------------------------------------------- V11
@register(
    "v11_top_dest",
    W(si.TRIPS_SQL)
    + ", m AS (SELECT pickup_gid, dropoff_gid, count(*) AS n, avg(trip_distance) AS mean_distance, avg(fare_amount) AS mean_fare, "
    "avg(tip_amount) AS mean_tip, avg(total_amount) AS mean_total, avg(passenger_count) AS mean_passengers, "
    "avg((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 86400.0) AS mean_days, "
    "avg(tip_amount) / avg(fare_amount) AS tip_pct FROM trips GROUP BY pickup_gid, dropoff_gid) "
    f"SELECT {i8('pickup_gid')} AS pickup_gid, {i8('dropoff_gid')} AS dropoff_gid, n, {r4('mean_distance')} AS mean_distance, "
    f"{r4('mean_fare')} AS mean_fare, {r4('mean_tip')} AS mean_tip, {r4('mean_total')} AS mean_total, {r4('mean_passengers')} AS mean_passengers, "
    f"{r4('mean_days')} AS mean_days, {r4('tip_pct')} AS tip_pct, {i8('rk')} AS rank FROM ("
    "SELECT *, rank() OVER (PARTITION BY pickup_gid ORDER BY n DESC) AS rk FROM m) WHERE rk <= 5",
)
def v11_top_dest(spark, d):
    """Top five destinations of every origin by trips, eight measures, ties kept."""
    from lodestar.plans import jobs

    return jobs.top_destinations(si.trips(spark, d), k=5)


# ---------------------------------------------------------------- V12
@register(
    "v12_enrich",
    W(si.TRIPS_SQL, si.NYCT_SQL)
    + f"SELECT {i8('t.order_id')} AS order_id, {ts_text('t.pickup_datetime')} AS pickup_datetime, {i8('t.pickup_gid')} AS pickup_gid, "
    f"p.boroname AS pickup_boro, p.ntaname AS pickup_nta, {ts_text('t.dropoff_datetime')} AS dropoff_datetime, {i8('t.dropoff_gid')} AS dropoff_gid, "
    "q.boroname AS dropoff_boro, q.ntaname AS dropoff_nta, CASE t.cab_type_id WHEN 'A' THEN 'yellow' WHEN 'R' THEN 'green' END AS cab_type, "
    f"t.vendor_id, {i8('t.passenger_count')} AS passenger_count, {r4('t.trip_distance')} AS trip_distance, "
    "CASE WHEN lower(trim(t.payment_type)) IN ('1-urgent', '2-high') THEN 'credit' WHEN lower(trim(t.payment_type)) IN ('3-medium') THEN 'cash' ELSE 'unk' END AS pay_type, "
    f"{r4('t.fare_amount')} AS fare_amount, {r4('t.tip_amount')} AS tip_amount, {r4('t.total_amount - t.fare_amount - t.tip_amount')} AS other_amount, "
    f"{r4('t.total_amount')} AS total_amount, {i8('floor(epoch(t.dropoff_datetime)) - floor(epoch(t.pickup_datetime))')} AS trip_seconds, "
    f"{i8('year(t.pickup_datetime)')} AS pickup_year "
    "FROM trips t LEFT JOIN nyct p ON t.pickup_gid = p.gid LEFT JOIN nyct q ON t.dropoff_gid = q.gid "
    "WHERE t.pickup_gid IS NOT NULL AND t.dropoff_gid IS NOT NULL AND t.fare_amount IS NOT NULL AND t.cab_type_id IN ('A', 'R')",
)
def v12_enrich(spark, d):
    """Trip enrichment with decoded codes and two role joins, 20 columns."""
    from lodestar.plans import jobs

    return jobs.trip_enrichment(si.trips(spark, d), si.nyct(spark, d))


# ---------------------------------------------------------------- V14 / V15
_GAIN_SQL = (
    ", g AS (SELECT f.*, a.description, f.depdelay - f.arrdelay AS gain FROM flights f LEFT JOIN airlines a ON f.uniquecarrier = a.code "
    "WHERE f.depdelay IS NOT NULL AND f.arrdelay IS NOT NULL AND f.distance IS NOT NULL AND f.depdelay > 5 AND f.depdelay < 45 "
    "AND f.arrdelay > 2 AND f.arrdelay < 48 AND f.year BETWEEN 1996 AND 2000) "
)


@register(
    "v14_gain_data",
    W(si.FLIGHTS_SQL, si.AIRLINES_SQL)
    + _GAIN_SQL
    + f"SELECT {i8('year')} AS year, uniquecarrier, description, {i8('tailnum')} AS tailnum, {r4('depdelay')} AS depdelay, "
    f"{r4('arrdelay')} AS arrdelay, {r4('gain')} AS gain FROM g",
)
def v14_gain_data(spark, d):
    """Model table: null and range filters, year range, carrier join, gain."""
    from lodestar.plans import jobs

    g = jobs.gain_model_data(si.flights(spark, d), si.airlines(spark, d), (5, 45), (1996, 2000), (2, 48))
    return g.select("year", "uniquecarrier", "description", "tailnum", "depdelay", "arrdelay", "gain")


@register(
    "v15_carrier_summary",
    W(si.FLIGHTS_SQL, si.AIRLINES_SQL)
    + _GAIN_SQL
    + f"SELECT uniquecarrier, count(*) AS n, {r4('avg(depdelay)')} AS mean_depdelay, {r4('avg(arrdelay)')} AS mean_arrdelay, "
    f"{r4('avg(gain)')} AS mean_gain, {r4('avg(distance)')} AS mean_distance, min(description) AS description FROM g GROUP BY uniquecarrier",
)
def v15_carrier_summary(spark, d):
    """Per-carrier delay and gain summary sorted by gain."""
    from lodestar.plans import jobs

    return jobs.carrier_summary(jobs.gain_model_data(si.flights(spark, d), si.airlines(spark, d), (5, 45), (1996, 2000), (2, 48)))


# ---------------------------------------------------------------- V17
def _gc_sql(n: int) -> str:
    f = f"(step / {float(n + 1)})"
    a = f"CASE WHEN dd = 0 THEN 1.0 - {f} ELSE sin((1.0 - {f}) * dd) / sin(dd) END"
    b = f"CASE WHEN dd = 0 THEN {f} ELSE sin({f} * dd) / sin(dd) END"
    x = f"(({a}) * cos(p1) * cos(l1) + ({b}) * cos(p2) * cos(l2))"
    y = f"(({a}) * cos(p1) * sin(l1) + ({b}) * cos(p2) * sin(l2))"
    z = f"(({a}) * sin(p1) + ({b}) * sin(p2))"
    return (
        ", r AS (SELECT DISTINCT origin, dest FROM flights), "
        "e AS (SELECT r.origin, r.dest, radians(o.lat) AS p1, radians(o.lon) AS l1, radians(t.lat) AS p2, radians(t.lon) AS l2 "
        "FROM r JOIN airports o ON r.origin = o.faa JOIN airports t ON r.dest = t.faa), "
        "h AS (SELECT *, 2.0 * asin(sqrt(least(pow(sin((p2 - p1) / 2), 2) + cos(p1) * cos(p2) * pow(sin((l2 - l1) / 2), 2), 1.0))) AS dd FROM e), "
        f"s AS (SELECT h.*, unnest(range(0, {n + 2})) AS step FROM h) "
        f"SELECT {i8('origin')} AS origin, {i8('dest')} AS dest, {i8('step')} AS step, "
        f"{r4(f'degrees(atan2({z}, sqrt({x} * {x} + {y} * {y})))')} AS lat, {r4(f'degrees(atan2({y}, {x}))')} AS lon FROM s"
    )


@register("v17_great_circle", W(si.FLIGHTS_SQL, si.AIRPORTS_SQL) + _gc_sql(10))
def v17_great_circle(spark, d):
    """Great-circle paths (10 inner points) of every route."""
    from lodestar.plans import jobs

    return jobs.great_circle_routes(si.flights(spark, d), si.airports(spark, d), 10)


# ---------------------------------------------------------------- V18
@register(
    "v18_carrier_network",
    W(si.FLIGHTS_SQL, si.AIRPORTS_SQL)
    + ", r AS (SELECT origin, dest, count(*) AS n FROM flights WHERE year = 1997 AND uniquecarrier = 'Brand#23' GROUP BY origin, dest HAVING count(*) > 1) "
    f"SELECT {i8('r.origin')} AS origin, {i8('r.dest')} AS dest, r.n, {i8('floor(r.n / (SELECT max(n) FROM r) * 100 + 0.5)')} AS colour, "
    f"{r4('o.lat')} AS lat1, {r4('o.lon')} AS lon1, {r4('t.lat')} AS lat2, {r4('t.lon')} AS lon2 "
    "FROM r JOIN airports o ON r.origin = o.faa JOIN airports t ON r.dest = t.faa",
)
def v18_carrier_network(spark, d):
    """Busy routes of one carrier in 1997 with a colour index and end coordinates."""
    from lodestar.plans import jobs

    return jobs.carrier_network(si.flights(spark, d), si.airports(spark, d), 1997, "Brand#23", 1)


# ---------------------------------------------------------------- V19
@register(
    "v19_tail_profile",
    W(si.FLIGHTS_SQL)
    + f"SELECT {i8('tailnum')} AS tailnum, count(*) AS n, {r4('avg(distance)')} AS dist, {r4('avg(arrdelay)')} AS delay, "
    f"{r4('avg(depdelay)')} AS depdelay FROM flights GROUP BY tailnum HAVING count(*) > 20 AND avg(distance) < 950 AND avg(arrdelay) IS NOT NULL",
)
def v19_tail_profile(spark, d):
    """Aircraft with over 20 flights and mean distance under 950."""
    from lodestar.plans import jobs

    return jobs.tail_profile(si.flights(spark, d), 20, 950)


# ---------------------------------------------------------------- V20
@register(
    "v20_top_names",
    W(si.BABYNAMES_SQL)
    + ", y AS (SELECT sex, name, sum(n) AS total FROM babynames WHERE year = 1998 GROUP BY sex, name), "
    "top AS (SELECT sex, name FROM (SELECT *, rank() OVER (PARTITION BY sex ORDER BY total DESC) AS rk FROM y) WHERE rk <= 4) "
    f"SELECT {i8('b.year')} AS year, b.sex, b.name, {r4('sum(b.n)')} AS total FROM babynames b "
    "WHERE EXISTS (SELECT 1 FROM top t WHERE t.sex = b.sex AND t.name = b.name) GROUP BY b.year, b.sex, b.name",
)
def v20_top_names(spark, d):
    """Top four names per sex in 1998 and their totals in every year."""
    from lodestar.plans import jobs

    return jobs.top_names_trend(si.babynames(spark, d), 1998, 4)


# ---------------------------------------------------------------- V21
@register(
    "v21_shared_names",
    W(si.BABYNAMES_SQL)
    + f"SELECT name, female, male, {i8('mean_year')} AS mean_year FROM ("
    f"SELECT name, {r4("sum(CASE WHEN sex = 'F' THEN n ELSE 0 END)")} AS female, {r4("sum(CASE WHEN sex = 'M' THEN n ELSE 0 END)")} AS male, "
    "floor(sum(year * n) / sum(n) + 0.5) AS mean_year FROM babynames GROUP BY name) WHERE female > 5000 AND male > 5000",
)
def v21_shared_names(spark, d):
    """Names used by both sexes above 5000 each, with weighted mean year."""
    from lodestar.plans import jobs

    return jobs.shared_names(si.babynames(spark, d), 5000)


# ---------------------------------------------------------------- V22
@register(
    "v22_births_by_year",
    W(si.BABYNAMES_SQL)
    + f"SELECT {i8('year')} AS year, {r4("sum(CASE WHEN sex = 'F' THEN n / 1000000.0 ELSE 0 END)")} AS F, "
    f"{r4("sum(CASE WHEN sex = 'M' THEN n / 1000000.0 ELSE 0 END)")} AS M FROM babynames GROUP BY year",
)
def v22_births_by_year(spark, d):
    """Counts by year and sex in millions."""
    from lodestar.plans import jobs

    return jobs.births_by_year(si.babynames(spark, d))


# ---------------------------------------------------------------- V23
FLAGS = ["Exit", "Guard"]
VERSIONS = ["v0.0", "v0.1", "v0.2", "v0.3"]


@register(
    "v23_daily_series",
    W(si.TOR_SQL)
    + ", r AS (SELECT date, platform, flag, regexp_replace(version, '^0', 'v0') AS version, relays FROM tor WHERE date >= DATE '2024-01-05') "
    f"SELECT {day_text('date')} AS date, {r4('sum(relays)')} AS total, "
    + ", ".join(f"{r4(f'sum(CASE WHEN platform = {chr(39)}{p}{chr(39)} THEN relays END)')} AS {p}" for p in PLATFORMS)
    + ", "
    + ", ".join(f"{r4(f'sum(CASE WHEN flag = {chr(39)}{x}{chr(39)} THEN relays END)')} AS flag_{x}" for x in FLAGS)
    + ", "
    + ", ".join(
        f"{r4(f'sum(CASE WHEN version = {chr(39)}{v}{chr(39)} THEN relays END)')} AS version_{v.replace('.', '_')}" for v in VERSIONS
    )
    + " FROM r GROUP BY date",
)
def v23_daily_series(spark, d):
    """Daily relay totals, by platform, by flag and by version from 2024-01-05, one scan."""
    from lodestar.plans import jobs

    return jobs.daily_series(si.tor_servers(spark, d), "2024-01-05", PLATFORMS, FLAGS, VERSIONS)


# ---------------------------------------------------------------- V25 / V26
@register("v25_trips_by_year", W(si.TRIPS_SQL) + f"SELECT {i8('year(pickup_datetime)')} AS year, count(*) AS n FROM trips GROUP BY 1")
def v25_trips_by_year(spark, d):
    """Trips per pickup year."""
    from lodestar.plans import jobs

    return jobs.trips_by_year(si.trips(spark, d))


@register(
    "v26_param_mean",
    W(si.TRIPS_SQL)
    + f"SELECT {r4('avg(fare_amount)')} AS fare_amount FROM trips WHERE hour(pickup_datetime) = 0",
)
def v26_param_mean(spark, d):
    """Mean fare of one hour of day given at run time."""
    from lodestar.plans import jobs

    return jobs.mean_fare_at(si.trips(spark, d), 0)


# ================================================================ models
def _labelled(spark, d):
    return si.titanic(spark, d).where(F.col("label").isNotNull())


_LABELLED_SQL = ", lab AS (SELECT * FROM titanic WHERE label IS NOT NULL) "
SPLITS = [0.0, 500.0, 2000.0, 10000.0, float("inf")]


@register(
    "m01_bucketize",
    f"SELECT {i8('doc_id')} AS doc_id, CASE WHEN n_chars >= 0 AND n_chars < 500 THEN 0.0 WHEN n_chars >= 500 AND n_chars < 2000 THEN 1.0 "
    "WHEN n_chars >= 2000 AND n_chars < 10000 THEN 2.0 WHEN n_chars >= 10000 THEN 3.0 END AS size_bin FROM documents",
)
def m01_bucketize(spark, d):
    """Document length in left-closed bins with ``Bucketizer``."""
    from lodestar.ml.features import bucketize

    docs = si.table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    return bucketize(docs, "n_chars", SPLITS, "size_bin").select("doc_id", "size_bin")


@register(
    "m02_cut_right",
    f"SELECT {i8('doc_id')} AS doc_id, CASE WHEN n_chars > 0 AND n_chars <= 500 THEN 0.0 WHEN n_chars > 500 AND n_chars <= 2000 THEN 1.0 "
    "WHEN n_chars > 2000 AND n_chars <= 10000 THEN 2.0 WHEN n_chars > 10000 THEN 3.0 END AS size_bin FROM documents",
)
def m02_cut_right(spark, d):
    """Document length in right-closed bins, R ``cut`` rule."""
    docs = si.table(spark, d, "documents")
    return docs.select("doc_id", verbs.bucket_closed_right(F.col("n_chars"), SPLITS).alias("size_bin"))


@register(
    "m04_simple_ols",
    W(si.TRIPS_SQL)
    + f"SELECT {r4('regr_slope(fare_amount, trip_distance)')} AS slope, {r4('regr_intercept(fare_amount, trip_distance)')} AS intercept, "
    f"{r4('regr_r2(fare_amount, trip_distance)')} AS r2 FROM trips",
)
def m04_simple_ols(spark, d):
    """One-predictor linear regression fitted with Spark ML, checked against the closed form."""
    from lodestar.ml import models

    from lodestar.ml.features import training_table

    # the fit and its summary read the two columns several times: materialise once
    t = training_table(si.trips(spark, d).select("fare_amount", "trip_distance"))
    m = models.fit_regressor(t, "fare_amount ~ trip_distance", "linear")
    lr = m.stages[-1]
    row = [(float(lr.coefficients[0]), float(lr.intercept), float(lr.summary.r2))]
    return spark.createDataFrame(row, "slope double, intercept double, r2 double")


@register("m05_linear_summary", None)
def m05_linear_summary(spark, d):
    """Coefficients with standard errors, t and p values, R², RMSE and residual quantiles of the gain model."""
    from lodestar.ml import gram

    return gram.linear_summary(_gain_table(spark, d), "gain", ["distance", "depdelay"], ["uniquecarrier"])


#: Moments of two predictors x, z and a label y over the rows of ``pts`` that satisfy a condition.
def _moments_sql(condition: str = "true") -> str:
    return (
        "SELECT count(*) AS n, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS vx, var_pop(z) AS vz, var_pop(y) AS vy, "
        f"covar_pop(x, z) AS cxz, covar_pop(x, y) AS cxy, covar_pop(z, y) AS czy FROM pts WHERE {condition}"
    )


_POINTS_SQL = ", pts AS (SELECT depdelay AS x, distance AS z, depdelay - arrdelay AS y FROM flights)"
_OLS_SQL = (
    _POINTS_SQL
    + f", mo AS ({_moments_sql()}), fit AS (SELECT *, (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) AS bx, "
    "(czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) AS bz FROM mo), "
    "lin AS (SELECT *, my - bx * mx - bz * mz AS b0, vy - bx * cxy - bz * czy AS mse, n * vx * (1 - cxz * cxz / (vx * vz)) AS sx, "
    "n * vz * (1 - cxz * cxz / (vx * vz)) AS sz FROM fit) "
)


@register(
    "m05_two_predictors",
    W(si.FLIGHTS_SQL)
    + _OLS_SQL
    + ", res AS (SELECT "
    + ", ".join(f"quantile_cont(y - b0 - bx * x - bz * z, {q}) AS q{i}" for i, q in enumerate((0, 0.25, 0.5, 0.75, 1)))
    + " FROM pts, lin), rows AS (SELECT '(Intercept)' AS term, b0 AS estimate, "
    "sqrt(mse * n / (n - 3) * (1 / n + (mx * mx * vz - 2 * mx * mz * cxz + mz * mz * vx) / (n * (vx * vz - cxz * cxz)))) AS std_error FROM lin "
    "UNION ALL SELECT 'depdelay', bx, sqrt(mse * n / (n - 3) / sx) FROM lin UNION ALL SELECT 'distance', bz, sqrt(mse * n / (n - 3) / sz) FROM lin) "
    f"SELECT term, {r4('estimate')} AS estimate, {r4('std_error')} AS std_error, {r4('estimate / std_error')} AS t_value, "
    f"{r4('1 - mse / vy')} AS r2, {r4('sqrt(mse)')} AS rmse, {r4('q0')} AS res_min, {r4('q1')} AS res_q1, {r4('q2')} AS res_median, "
    f"{r4('q3')} AS res_q3, {r4('q4')} AS res_max FROM rows, lin, res",
)
def m05_two_predictors(spark, d):
    """Summary of the gain model on two predictors with the residual quantiles, against the closed form."""
    from lodestar.ml import gram

    return gram.linear_summary(_gain_table(spark, d), "gain", ["depdelay", "distance"]).drop("p_value")


def _classifier_metrics(spark, d, kind: str) -> DataFrame:
    from lodestar.ml import evaluate, models

    parts = verbs.hash_split(_labelled(spark, d), {"train": 0.75, "valid": 0.25}, "doc_id")
    m = models.fit_classifier(parts["train"], "label ~ n_chars + lang + source", kind)
    scored = models.positive_probability(m.transform(parts["valid"]))
    a = evaluate.auc(scored, "score", "label").select("auc")
    acc = evaluate.accuracy_at(scored, "score", "label", 0.5)
    return a.withColumn("accuracy", acc.scalar())


for _kind, _key in [
    ("logistic", "m06_logistic"),
    ("decision_tree", "m07_decision_tree"),
    ("random_forest", "m08_random_forest"),
    ("gbt", "m09_gbt"),
    ("naive_bayes", "m10_naive_bayes"),
]:
    register(_key, None)(lambda spark, d, _k=_kind: _classifier_metrics(spark, d, _k))


@register("m11_perceptron", None)
def m11_perceptron(spark, d):
    """Perceptron whose input layer is the encoded width."""
    from lodestar.ml import evaluate, models

    parts = verbs.hash_split(_labelled(spark, d), {"train": 0.75, "valid": 0.25}, "doc_id")
    m = models.fit_perceptron(parts["train"], "label ~ n_chars + lang + source", hidden=(15,))
    scored = models.positive_probability(m.transform(parts["valid"]))
    return evaluate.auc(scored, "score", "label")


@register("m12_kmeans", None)
def m12_kmeans(spark, d):
    """K-means on the embeddings (k = 10), cluster sizes and within-cluster SS."""
    from lodestar.ml import features, models

    e = features.array_features(si.table(spark, d, "embeddings"), "embedding")
    km = models.kmeans(e, "features", 10)
    return models.cluster_stats(km, e, "features").drop("centre")


@register(
    "m15_auc",
    W(si.TITANIC_SQL)
    + _LABELLED_SQL
    + ", rk AS (SELECT label, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM lab) "
    f"SELECT {r4('(sum(CASE WHEN label > 0 THEN r ELSE 0 END) - sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) * (sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) + 1) / 2.0) / (sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) * sum(CASE WHEN label > 0 THEN 0 ELSE 1 END))')} AS auc, "
    f"{i8('sum(CASE WHEN label > 0 THEN 1 ELSE 0 END)')} AS n_pos, {i8('sum(CASE WHEN label > 0 THEN 0 ELSE 1 END)')} AS n_neg FROM rk",
)
def m15_auc(spark, d):
    """AUC of document length as a toxicity score, by the rank-sum identity."""
    from lodestar.ml import evaluate

    return evaluate.auc(_labelled(spark, d), "n_chars", "label")


@register(
    "m16_accuracy",
    W(si.TITANIC_SQL) + _LABELLED_SQL
    + f"SELECT {r4('avg(CASE WHEN (CASE WHEN quality > 0.5 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM lab",
)
def m16_accuracy(spark, d):
    """Accuracy of the quality flag as a toxicity prediction at cut 0.5."""
    from lodestar.ml import evaluate

    return evaluate.accuracy_at(_labelled(spark, d), "quality", "label", 0.5)


@register("m17_importance", None)
def m17_importance(spark, d):
    """Named feature importances of a random forest."""
    from lodestar.ml import models

    lab = _labelled(spark, d)
    m = models.fit_classifier(lab, "label ~ n_chars + lang + source", "random_forest")
    return models.feature_importance(m, lab)


@register(
    "m18_lift",
    W(si.TITANIC_SQL)
    + _LABELLED_SQL
    + ", t AS (SELECT label, ntile(10) OVER (ORDER BY n_chars DESC, doc_id) AS bin FROM lab), "
    "g AS (SELECT bin, sum(CAST(label AS DOUBLE)) AS cnt FROM t GROUP BY bin), "
    "s AS (SELECT bin, cnt, cnt / (SELECT sum(cnt) FROM g) AS share FROM g) "
    f"SELECT {i8('bin')} AS bin, {r4('cnt')} AS count, {r4('sum(share) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS prop FROM s",
)
def m18_lift(spark, d):
    """Cumulative gains by decile of a score column."""
    from lodestar.ml import evaluate

    return evaluate.lift_table(_labelled(spark, d), "n_chars", "label", "doc_id")


_M19_SQL = (
    ", g AS (SELECT year, depdelay, depdelay - arrdelay AS gain FROM flights), "
    "fit AS (SELECT regr_slope(gain, depdelay) AS b, regr_intercept(gain, depdelay) AS a FROM g WHERE year <= 1998), "
    "p AS (SELECT CASE WHEN year <= 1998 THEN 'train' ELSE 'valid' END AS data, gain, fit.a + fit.b * depdelay AS pred FROM g, fit), "
    "t AS (SELECT data, gain, pred, ntile(10) OVER (PARTITION BY data ORDER BY pred DESC, gain) AS decile FROM p) "
    f"SELECT data, {i8('decile')} AS decile, count(*) AS n, {r4('avg(gain)')} AS mean_actual, {r4('avg(pred)')} AS mean_pred FROM t GROUP BY data, decile"
)


@register("m19_deciles", W(si.FLIGHTS_SQL) + _M19_SQL)
def m19_deciles(spark, d):
    """Gain model fitted on years up to 1998; mean actual vs predicted by decile,
    training years against later years (M19, M21, M14)."""
    from lodestar.ml import evaluate, models

    from lodestar.ml.features import training_table

    # the five-way join is read by the fit and by both scorings: materialise it once
    g = training_table(
        si.flights(spark, d).select("year", "depdelay", (F.col("depdelay") - F.col("arrdelay")).alias("gain"))
    )
    train, valid = g.where(F.col("year") <= 1998), g.where(F.col("year") > 1998)
    m = models.fit_regressor(train, "gain ~ depdelay", "linear")
    return evaluate.decile_table(
        {"train": m.transform(train).select("gain", F.col("prediction").alias("pred")),
         "valid": m.transform(valid).select("gain", F.col("prediction").alias("pred"))},
        "pred", "gain",
    )


def _gain_table(spark, d):
    return si.flights(spark, d).select(
        "year", "uniquecarrier", "distance", "depdelay", "arrdelay", (F.col("depdelay") - F.col("arrdelay")).alias("gain")
    )


def _gain_rows(spark, d, *columns):
    """The gain table for models that read it several times: the five-way join runs once."""
    from lodestar.session import written_rows

    return written_rows(_gain_table(spark, d).select(*columns), "gain")


@register("m20_residual_hist", None)
def m20_residual_hist(spark, d):
    """Residuals of the gain model and their 30-bin histogram."""
    from lodestar.ml import evaluate, models

    g = _gain_rows(spark, d, "depdelay", "distance", "gain")
    m = models.fit_regressor(g, "gain ~ depdelay + distance", "linear")
    res = evaluate.residuals(m.transform(g), "gain")
    return visagg.histogram(res, "residual", 30)


@register("m21_out_of_time", None)
def m21_out_of_time(spark, d):
    """Fit on years up to 1998, score later years; metrics per period."""
    from lodestar.ml import evaluate, models

    g = _gain_rows(spark, d, "year", "uniquecarrier", "distance", "depdelay", "gain")
    train, later = g.where(F.col("year") <= 1998), g.where(F.col("year") > 1998)
    m = models.fit_regressor(train, "gain ~ depdelay + distance + uniquecarrier", "linear")
    return setops.tagged_union(
        {"train": evaluate.regression_metrics(m.transform(train), "gain"),
         "later": evaluate.regression_metrics(m.transform(later), "gain")},
        "period",
    )


@register(
    "m22_glm_gaussian",
    W(si.FLIGHTS_SQL)
    + _OLS_SQL
    + f"SELECT '(Intercept)' AS term, {r4('b0')} AS estimate FROM lin UNION ALL SELECT 'depdelay', {r4('bx')} FROM lin "
    f"UNION ALL SELECT 'distance', {r4('bz')} FROM lin",
)
def m22_glm_gaussian(spark, d):
    """Gaussian GLM without penalty; coefficients equal the least-squares fit."""
    from lodestar.ml import models

    g = _gain_rows(spark, d, "depdelay", "distance", "gain")
    m = models.fit_regressor(g, "gain ~ depdelay + distance", "glm_gaussian")
    glm = m.stages[-1]
    rows = [("(Intercept)", float(glm.intercept))] + [
        (n, float(c)) for n, c in zip(models.feature_names(m, g), glm.coefficients)
    ]
    return spark.createDataFrame(rows, "term string, estimate double")


@register("m23_penalty_path", None)
def m23_penalty_path(spark, d):
    """Elastic-net path of a linear model with carrier levels, chosen on a held-out part, from one scan."""
    from lodestar.ml import gram

    g = _gain_table(spark, d)
    held = sampling.fold_of(["year", "depdelay", "arrdelay"], 5) == 0
    return gram.penalty_path(g, "gain", ["depdelay", "distance"], ["uniquecarrier"], [0.0, 0.01, 0.1, 1.0], held, 0.5)[1]


_KEYED_POINTS_SQL = (
    ", pts AS (SELECT l.l_quantity AS x, p.p_retailprice AS z, l.l_quantity - CAST(p.p_size AS DOUBLE) AS y, "
    f"{sampling.hash_sql(['l_orderkey', 'l_linenumber'])} AS h FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"
)


def _keyed_gain(spark, d):
    li, p = si.table(spark, d, "lineitem"), si.table(spark, d, "part")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("depdelay"), F.col("p_retailprice").alias("distance"),
        (F.col("l_quantity") - F.col("p_size")).alias("gain"),
    )


def _ridge_sql(source: str) -> str:
    """Ridge on two predictors for each penalty of ``pen`` from the moments in ``source``: bx, bz, b0 beside the moments."""
    return (
        "SELECT *, my - bx * mx - bz * mz AS b0 FROM (SELECT *, ((1 + penalty) * rx - rho * rz) / ((1 + penalty) ** 2 - rho * rho) / sqrt(vx) AS bx, "
        "((1 + penalty) * rz - rho * rx) / ((1 + penalty) ** 2 - rho * rho) / sqrt(vz) AS bz FROM "
        f"(SELECT *, cxy / sqrt(vx) AS rx, czy / sqrt(vz) AS rz, cxz / sqrt(vx * vz) AS rho FROM {source}, pen))"
    )


_PENALTIES = [i / 25 for i in range(50)]
_PEN_SQL = "pen AS (SELECT i / 25 AS penalty FROM range(50) t(i))"


@register(
    "m23_ridge_path",
    "WITH " + _KEYED_POINTS_SQL[2:] + f", {_PEN_SQL}, mo AS ({_moments_sql('h % 5 <> 0')}), fit AS ({_ridge_sql('mo')}) "
    f"SELECT penalty, {r4('any_value(bx)')} AS bx, {r4('any_value(bz)')} AS bz, {r4('any_value(b0)')} AS b0, "
    f"{r4('sqrt(avg((y - b0 - bx * x - bz * z) ** 2))')} AS rmse FROM fit JOIN (SELECT x, z, y FROM pts WHERE h % 5 = 0) ON true GROUP BY penalty",
)
def m23_ridge_path(spark, d):
    """Ridge path of 50 penalties from one scan, coefficients and held-out RMSE against the closed form."""
    from lodestar.ml import gram

    g = _keyed_gain(spark, d)
    held = sampling.fold_of(["l_orderkey", "l_linenumber"], 5) == 0
    fits, table = gram.penalty_path(g, "gain", ["depdelay", "distance"], [], _PENALTIES, held)
    wide = gram.coefficient_table(g, fits).groupBy("penalty").pivot("term", ["depdelay", "distance", "(Intercept)"]).agg(F.first("estimate"))
    return wide.toDF("penalty", "bx", "bz", "b0").join(table.select("penalty", "rmse"), "penalty")


@register(
    "m24_ridge_folds",
    "WITH " + _KEYED_POINTS_SQL[2:] + ", pen AS (SELECT unnest([0.0, 0.1, 1.0]::DOUBLE[]) AS penalty), "
    + ", ".join(f"mo{k} AS ({_moments_sql(f'h % 3 <> {k}')}), fit{k} AS ({_ridge_sql(f'mo{k}')})" for k in range(3))
    + ", ".join(["", "fits AS (" + " UNION ALL ".join(f"SELECT {k} AS fold, * FROM fit{k}" for k in range(3)) + ") "])
    + f"SELECT penalty, CAST(fold AS BIGINT) AS fold, count(*) AS n, {r4('sqrt(avg((pts.y - b0 - bx * pts.x - bz * pts.z) ** 2))')} AS rmse "
    "FROM fits JOIN pts ON pts.h % 3 = fold GROUP BY penalty, fold",
)
def m24_ridge_folds(spark, d):
    """Three-fold cross-validation of a ridge path from one scan; each fold is left out by subtraction."""
    from lodestar.ml import gram

    fold = sampling.fold_of(["l_orderkey", "l_linenumber"], 3)
    return gram.cross_validate(_keyed_gain(spark, d), "gain", ["depdelay", "distance"], [], [0.0, 0.1, 1.0], fold)


@register("m24_cv_logistic", None)
def m24_cv_logistic(spark, d):
    """Binomial GLM with 3-fold cross-validation, AUC per penalty and fold, one scan per Newton step."""
    from lodestar.ml import logistic_cv

    return logistic_cv.cross_validate(_labelled(spark, d), "label", ["n_chars"], ["lang", "source"], [0.0, 0.01, 0.1], 3, "doc_id")


@register(
    "m24_fold_sizes",
    W(si.TITANIC_SQL) + _LABELLED_SQL + f"SELECT CAST({sampling.hash_sql(['doc_id'])} % 3 AS BIGINT) AS fold, count(*) AS n FROM lab GROUP BY 1",
)
def m24_fold_sizes(spark, d):
    """Sizes of the folds by the portable hash of the key."""
    return rollups.group_count(_labelled(spark, d).select(sampling.fold_of("doc_id", 3).alias("fold")), "fold")


@register("m25_pca", None)
def m25_pca(spark, d):
    """Principal components of the embeddings, explained variance of the first four."""
    from lodestar.ml import features, models

    e = features.array_features(si.table(spark, d, "embeddings"), "embedding")
    _, table = models.pca(e, "features", 4)
    return table


@register("m26_multiclass_forest", None)
def m26_multiclass_forest(spark, d):
    """Ten-class random forest (32 bins, depth 5, 20 trees) scored on a held-out part;
    confusion counts (M26)."""
    from pyspark.ml.classification import RandomForestClassifier

    from lodestar.ml import evaluate, features

    e = features.array_features(si.table(spark, d, "embeddings"), "embedding")
    parts = verbs.hash_split(e, {"train": 0.8, "valid": 0.2}, "vec_id")
    rf = RandomForestClassifier(labelCol="label", maxBins=32, maxDepth=5, numTrees=20, seed=42)
    m = rf.fit(parts["train"])
    return evaluate.confusion(m.transform(parts["valid"]), "label", classes=list(range(10)))


@register("m27_one_vs_rest_gbt", None)
def m27_one_vs_rest_gbt(spark, d):
    """Ten-class boosted trees as one-vs-rest binary models; accuracy on a held-out part."""
    from lodestar.ml import features, models

    e = features.array_features(si.table(spark, d, "embeddings"), "embedding").withColumn("label", F.col("label").cast("double"))
    parts = verbs.hash_split(e, {"train": 0.8, "valid": 0.2}, "vec_id")
    m = models.one_vs_rest_gbt(parts["train"], "features", "label", step=0.1, col_rate="0.7")
    scored = m.transform(parts["valid"])
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@register("m28_grid_search", None)
def m28_grid_search(spark, d):
    """Grid of tree settings ranked by validation MSE."""
    from pyspark.ml.regression import DecisionTreeRegressor

    from lodestar.ml import search

    g = _gain_rows(spark, d, "year", "depdelay", "arrdelay", "distance", "gain")
    parts = verbs.hash_split(g, {"train": 0.8, "valid": 0.2}, ["year", "depdelay", "arrdelay", "distance"])
    return search.grid_search(
        parts["train"], parts["valid"], "gain ~ depdelay + distance", DecisionTreeRegressor(seed=42),
        {"maxDepth": [2, 4, 6], "maxBins": [16, 32]},
    )


@register("m28_successive_halving", None)
def m28_successive_halving(spark, d):
    """The same grid by successive halving on nested hash samples."""
    from pyspark.ml.regression import DecisionTreeRegressor

    from lodestar.ml import search

    return search.halving_search(
        _keyed_gain(spark, d), ["l_orderkey", "l_linenumber"], "gain ~ depdelay + distance", DecisionTreeRegressor(seed=42),
        {"maxDepth": [2, 4, 6], "maxBins": [16, 32]},
    )


@register("m29_random_search", None)
def m29_random_search(spark, d):
    """Best row of a seeded random subset (4 of 12) of a tree grid, by validation MSE."""
    from pyspark.ml.regression import DecisionTreeRegressor

    from lodestar.ml import search

    return search.halving_search(
        _keyed_gain(spark, d), ["l_orderkey", "l_linenumber"], "gain ~ depdelay + distance", DecisionTreeRegressor(seed=42),
        {"maxDepth": [2, 3, 4, 5], "minInstancesPerNode": [1, 5, 20]}, max_models=4,
    ).where("rank = 1")


@register("m31_model_comparison", None)
def m31_model_comparison(spark, d):
    """Train and test MSE of linear, GLM and tree models."""
    from lodestar.ml import search

    g = _gain_rows(spark, d, "year", "depdelay", "arrdelay", "distance", "gain")
    parts = verbs.hash_split(g, {"train": 0.8, "test": 0.2}, ["year", "depdelay", "arrdelay", "distance"])
    return search.compare_regressors(parts["train"], parts["test"], "gain ~ depdelay + distance", "gain")


@register("m33_compare_classifiers", None)
def m33_compare_classifiers(spark, d):
    """All classifiers refitted on a chosen feature set and split; held-out AUC."""
    from lodestar.ml import search

    return search.compare_classifiers(_labelled(spark, d), "label", ["n_chars", "lang"], key="doc_id", train_frac=0.75)


# ================================================================ sampling
_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINES = (
    "SELECT "
    + ", ".join(f"{i8(c)} AS {c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    + ", "
    + ", ".join(f"{r4(c)} AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    + f", l_returnflag, l_linestatus, {day_text('l_shipdate')} AS shipped FROM lineitem "
)


def _lines(spark, d):
    li = si.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("shipped"),
    )


@register("p16_bernoulli_sample", _LINES + f"WHERE {sampling.hash_sql(_LINE_KEY, 7)} < {round(Fraction(0.01) * 2**sampling.HASH_BITS)}")
def p16_bernoulli_sample(spark, d):
    """Bernoulli 1 % sample of the line items by a hash that any engine repeats."""
    return sampling.hash_sample(_lines(spark, d), 0.01, _LINE_KEY, seed=7)


_LINE_ORDER = (
    "lineitem.l_orderkey, lineitem.l_partkey, lineitem.l_suppkey, lineitem.l_linenumber, lineitem.l_quantity, lineitem.l_extendedprice, "
    "lineitem.l_discount, lineitem.l_tax, l_returnflag, l_linestatus, l_shipdate"
)


@register("p17_sample_exact", _LINES + f"ORDER BY {sampling.hash_sql(_LINE_KEY, 7)}, {_LINE_ORDER} LIMIT 500")
def p17_sample_exact(spark, d):
    """Exactly 500 line items, those of the smallest hashes; equal keys by all columns."""
    return verbs.sample_exact(_lines(spark, d), 500, seed=7, key=_LINE_KEY)


@register(
    "p18_split",
    f"SELECT CASE WHEN {sampling.hash_sql(['o_orderkey'], 7)} < {round(Fraction(0.8) / (Fraction(0.8) + Fraction(0.2)) * 2**sampling.HASH_BITS)} "
    "THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM orders GROUP BY 1",
)
def p18_split(spark, d):
    """Seeded 80 / 20 hash split of the orders; part sizes."""
    parts = verbs.hash_split(si.table(spark, d, "orders"), {"train": 0.8, "test": 0.2}, "o_orderkey", seed=7)
    return setops.tagged_union({k: rollups.row_count(v) for k, v in parts.items()}, "part")


@register(
    "m35_exact_split",
    f"SELECT {i8('o_orderkey')} AS o_orderkey, CASE WHEN row_number() OVER (ORDER BY {sampling.hash_sql(['o_orderkey'], 7)}) "
    "<= floor(0.7 * count(*) OVER () + 0.5) THEN 'train' ELSE 'test' END AS part FROM orders",
)
def m35_exact_split(spark, d):
    """70 / 30 split of the orders into parts of exact sizes."""
    orders = si.table(spark, d, "orders").select("o_orderkey")
    return setops.tagged_union(sampling.split_by_weights(orders, {"train": Fraction(7, 10), "test": Fraction(3, 10)}, "o_orderkey", seed=7), "part")


# ================================================================ verbs
@register(
    "p01_select_range",
    f"SELECT {r4('l_quantity')} AS l_quantity, {r4('l_extendedprice')} AS l_extendedprice, {r4('l_discount')} AS l_discount, "
    f"{r4('l_tax')} AS l_tax, {i8('l_orderkey')} AS l_orderkey FROM lineitem",
)
def p01_select_range(spark, d):
    """``select(l_quantity:l_tax, l_orderkey)``."""
    return verbs.select_range(si.table(spark, d, "lineitem"), "l_quantity", "l_tax", "l_orderkey")


@register(
    "p02_rename_derive",
    f"SELECT {i8('o_orderkey')} AS order_id, {r4('o_totalprice')} AS price, {r4('o_totalprice / 1000')} AS price_k, "
    f"{r4('o_totalprice / 1000 * 2')} AS price_k2, o_orderpriority AS priority FROM orders",
)
def p02_rename_derive(spark, d):
    """Project with rename, drop, rename again and chained derived columns."""
    o = verbs.select_as(si.table(spark, d, "orders"), {"order_id": "o_orderkey", "price": "o_totalprice", "status": "o_orderstatus", "o_orderpriority": "o_orderpriority"})
    o = verbs.drop_cols(o, "status")
    o = verbs.rename(o, {"o_orderpriority": "priority"})
    return verbs.derive(o, {"price_k": F.col("price") / 1000, "price_k2": "price_k * 2"})


@register(
    "p08_filters",
    f"SELECT 'and' AS kind, {i8('count(*)')} AS n FROM lineitem WHERE l_discount > 0.05 AND l_tax < 0.02 "
    f"UNION ALL SELECT 'or', {i8('count(*)')} FROM lineitem WHERE l_quantity = (SELECT min(l_quantity) FROM lineitem) OR l_quantity = (SELECT max(l_quantity) FROM lineitem)",
)
def p08_filters(spark, d):
    """Conjunctive filter and a disjunction against whole-table extremes."""
    li = si.table(spark, d, "lineitem")
    both = verbs.where_all(li, F.col("l_discount") > 0.05, "l_tax < 0.02")
    either = verbs.where_any(
        li, F.col("l_quantity") == fx.scalar_of(li, F.min("l_quantity")), F.col("l_quantity") == fx.scalar_of(li, F.max("l_quantity"))
    )
    return setops.tagged_union({"and": rollups.row_count(both), "or": rollups.row_count(either)}, "kind")


@register(
    "p11_null_filters",
    W(si.TITANIC_SQL)
    + f"SELECT 'subset' AS kind, {i8('count(*)')} AS n FROM titanic WHERE quality IS NOT NULL AND label IS NOT NULL "
    f"UNION ALL SELECT 'any', {i8('count(*)')} FROM titanic WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL "
    "AND n_chars IS NOT NULL AND quality IS NOT NULL AND label IS NOT NULL",
)
def p11_null_filters(spark, d):
    """Rows without NULL in chosen columns, and in any column."""
    t = si.titanic(spark, d)
    return setops.tagged_union(
        {"subset": rollups.row_count(verbs.drop_missing(t, ["quality", "label"])), "any": rollups.row_count(verbs.drop_missing(t))},
        "kind",
    )


@register("p14_distinct_sorted", "SELECT DISTINCT p_brand FROM part")
def p14_distinct_sorted(spark, d):
    """Sorted distinct brands."""
    return verbs.distinct_sorted(si.table(spark, d, "part"), "p_brand")


@register(
    "p22_recode_key",
    W(si.FLIGHTS_SQL)
    + "SELECT CASE WHEN flightnum = 7 THEN 'DH' ELSE uniquecarrier END AS carrier, count(*) AS n FROM flights GROUP BY 1",
)
def p22_recode_key(spark, d):
    """Carrier recoded where a condition holds, else kept."""
    f = si.flights(spark, d).withColumn(
        "carrier", F.when(F.col("flightnum") == 7, F.lit("DH")).otherwise(F.col("uniquecarrier"))
    )
    return rollups.group_count(f, "carrier")


@register("p24_bool_col", "SELECT p_size = 8 AS size8, count(*) AS n FROM part GROUP BY 1")
def p24_bool_col(spark, d):
    """Boolean derived column."""
    return rollups.group_count(si.table(spark, d, "part").withColumn("size8", F.col("p_size") == 8), "size8")


# ================================================================ aggregates
@register(
    "a04_means",
    W(si.TRIPS_SQL)
    + f"SELECT vendor_id, count(*) AS n, {r4('avg(fare_amount)')} AS fare, {r4('avg(tip_amount)')} AS tip, {r4('avg(total_amount)')} AS total, "
    f"{r4('sum(fare_amount) / 1000000')} AS fare_millions, {r4('min(fare_amount)')} AS min_fare, {r4('max(fare_amount)')} AS max_fare, "
    "min(payment_type) AS first_payment FROM trips GROUP BY vendor_id",
)
def a04_means(spark, d):
    """Means, scaled sum, min / max (also of text) per vendor."""
    return rollups.summarize(
        si.trips(spark, d), "vendor_id",
        {
            "n": F.count(F.lit(1)),
            "fare": F.avg("fare_amount"),
            "tip": F.avg("tip_amount"),
            "total": F.avg("total_amount"),
            "fare_millions": F.sum("fare_amount") / F.lit(1_000_000),
            "min_fare": F.min("fare_amount"),
            "max_fare": F.max("fare_amount"),
            "first_payment": F.min("payment_type"),
        },
    )


@register(
    "a10_pivot_sum",
    W(si.BABYNAMES_SQL)
    + f"SELECT {i8('year')} AS year, {r4("sum(CASE WHEN sex = 'F' THEN n END)")} AS F, {r4("sum(CASE WHEN sex = 'M' THEN n END)")} AS M "
    "FROM babynames GROUP BY year",
)
def a10_pivot_sum(spark, d):
    """Per-class sums as columns with ``pivot``."""
    return rollups.pivot_wide(si.babynames(spark, d), "year", "sex", ["F", "M"], F.sum("n"))


@register(
    "a18_null_category",
    W(si.TOR_SQL)
    + f"SELECT {day_text('date')} AS date, {r4("sum(CASE WHEN coalesce(flag, 'None') = 'Exit' THEN relays END)")} AS Exit, "
    f"{r4("sum(CASE WHEN coalesce(flag, 'None') = 'Guard' THEN relays END)")} AS Guard, "
    f"{r4("sum(CASE WHEN coalesce(flag, 'None') = 'None' THEN relays END)")} AS None FROM tor GROUP BY date",
)
def a18_null_category(spark, d):
    """NULL category recoded before the pivot."""
    t = si.tor_servers(spark, d).withColumn("flag", F.coalesce("flag", F.lit("None")))
    return rollups.pivot_wide(t, "date", "flag", ["Exit", "Guard", "None"], F.sum("relays"))


@register(
    "a21_mse",
    W(si.TRIPS_SQL)
    + f"SELECT vendor_id, {r4('avg(pow(total_amount - fare_amount, 2))')} AS mse FROM trips GROUP BY vendor_id",
)
def a21_mse(spark, d):
    """Mean squared difference between two columns per vendor."""
    return rollups.mean_squared_error(si.trips(spark, d), "total_amount", "fare_amount", by="vendor_id")


@register(
    "a22_null_audit",
    W(si.TITANIC_SQL)
    + "SELECT c AS \"column\", CAST(nulls AS BIGINT) AS nulls, "
    + r4("nulls / rows_")
    + " AS null_rate FROM (SELECT count(*) AS rows_, "
    + ", ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in ["doc_id", "lang", "source", "n_chars", "quality", "label"])
    + " FROM titanic) UNPIVOT (nulls FOR c IN (doc_id, lang, source, n_chars, quality, label))",
)
def a22_null_audit(spark, d):
    """NULL count and rate of every column in one pass."""
    return rollups.null_audit(si.titanic(spark, d))


@register(
    "a29_cancelled",
    W(si.FLIGHTS_SQL)
    + f"SELECT {i8('dest')} AS dest, {i8('month')} AS month, count(*) AS n, {r4('avg(cancelled)')} AS cancel_rate, "
    f"{i8('sum(cancelled)')} AS cancelled FROM flights GROUP BY dest, month HAVING sum(cancelled) > 80",
)
def a29_cancelled(spark, d):
    """Cancellations per destination and month, busy cells only."""
    return rollups.summarize(
        si.flights(spark, d), ["dest", "month"],
        {"n": F.count(F.lit(1)), "cancel_rate": F.avg("cancelled"), "cancelled": F.sum("cancelled")},
    ).where(F.col("cancelled") > 80)


# ================================================================ functions
@register(
    "f09_text_functions",
    f"SELECT {i8('doc_id')} AS doc_id, lower(lang) AS lang_lc, substring(text, 1, 20) AS head20, "
    "regexp_replace(source, '^src', 's') AS src_short, TRY_CAST(regexp_replace(source, '^src', '') AS INTEGER) AS src_no, "
    f"TRY_CAST(lang AS INTEGER) AS lang_no, CAST(n_chars AS VARCHAR) AS n_chars_txt, {r4('CAST(n_chars AS DOUBLE)')} AS n_chars_dbl FROM documents",
)
def f09_text_functions(spark, d):
    """lower, substring, regexp_replace, casts and try_cast."""
    docs = si.table(spark, d, "documents")
    return docs.select(
        "doc_id",
        F.lower("lang").alias("lang_lc"),
        F.substring("text", 1, 20).alias("head20"),
        F.regexp_replace("source", "^src", "s").alias("src_short"),
        F.regexp_replace("source", "^src", "").try_cast("int").alias("src_no"),
        F.col("lang").try_cast("int").alias("lang_no"),
        F.col("n_chars").cast("string").alias("n_chars_txt"),
        F.col("n_chars").cast("double").alias("n_chars_dbl"),
    )


@register(
    "f16_text_dates",
    "SELECT d AS day, count(*) AS n FROM (SELECT strftime(ts, '%Y-%m-%d') AS d FROM events) "
    "WHERE CAST(strptime(d, '%Y-%m-%d') AS DATE) >= DATE '2024-01-15' GROUP BY d",
)
def f16_text_dates(spark, d):
    """Dates kept as text, parsed with a pattern, compared as dates (F16)."""
    e = si.table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e = e.where(F.to_date("day", "yyyy-MM-dd") >= F.lit("2024-01-15").cast("date"))
    return rollups.group_count(e, "day")


@register(
    "f20_zscore",
    f"SELECT {i8('p_partkey')} AS p_partkey, {r4('log10(p_retailprice)')} AS log_price, "
    f"{r4('(sqrt(p_size) - (SELECT avg(sqrt(p_size)) FROM part)) / (SELECT stddev_samp(sqrt(p_size)) FROM part)')} AS z FROM part",
)
def f20_zscore(spark, d):
    """log10 and the z-score of sqrt(size) over the whole table."""
    p = si.table(spark, d, "part").withColumn("s", F.sqrt("p_size"))
    return p.select("p_partkey", F.log10("p_retailprice").alias("log_price"), fx.z_score(p, "s").alias("z"))


# ================================================================ more jobs
@register(
    "v10_profile_regroup",
    "SELECT event_type, count(*) AS n_hours, "
    + r4("avg(mean_value)") + " AS mean_of_hourly_means, " + r4("min(mean_value)") + " AS min_hourly_mean, "
    + r4("max(mean_value)") + " AS max_hourly_mean FROM (SELECT event_type, hour(ts) AS h, avg(value) AS mean_value "
    "FROM events GROUP BY event_type, hour(ts)) GROUP BY event_type",
)
def v10_profile_regroup(spark, d):
    """Hourly means per event type, then a second-level summary of those means."""
    e = si.table(spark, d, "events").withColumn("h", F.hour("ts"))
    hourly = rollups.summarize(e, ["event_type", "h"], {"mean_value": F.avg("value")})
    return rollups.summarize(
        hourly, "event_type",
        {"n_hours": F.count(F.lit(1)), "mean_of_hourly_means": F.avg("mean_value"),
         "min_hourly_mean": F.min("mean_value"), "max_hourly_mean": F.max("mean_value")},
    )


@register(
    "v16_route_lookup",
    W(si.FLIGHTS_SQL, si.AIRLINES_SQL)
    + ", g AS (SELECT origin, dest, uniquecarrier AS carrier, description AS airline, distance, depdelay, arrdelay, depdelay - arrdelay AS gain "
    "FROM flights LEFT JOIN airlines ON uniquecarrier = code), "
    "fit AS (SELECT regr_slope(gain, depdelay) AS b, regr_intercept(gain, depdelay) AS a FROM g) "
    f"SELECT {i8('origin')} AS origin, {i8('dest')} AS dest, carrier, airline, count(*) AS flights, {r4('avg(distance)')} AS distance, "
    f"{r4('avg(depdelay)')} AS avg_dep_delay, {r4('avg(arrdelay)')} AS avg_arr_delay, {r4('avg(gain)')} AS avg_gain, "
    f"{r4('avg(fit.a + fit.b * depdelay)')} AS pred_gain FROM g, fit GROUP BY origin, dest, carrier, airline",
)
def v16_route_lookup(spark, d):
    """Scored flights rolled up by route and carrier, the table served to point lookups."""
    from lodestar.ml import models
    from lodestar.plans import jobs

    g = si.flights(spark, d).withColumn("gain", F.col("depdelay") - F.col("arrdelay"))
    m = models.fit_regressor(g.select("gain", "depdelay"), "gain ~ depdelay", "linear")
    return jobs.route_summary(joins.lookup_join(m.transform(g), si.airlines(spark, d), {"uniquecarrier": "code"}))


@register(
    "v27_feature_prep",
    W(si.TITANIC_SQL)
    + f"SELECT {i8('doc_id')} AS doc_id, {r4('coalesce(CAST(quality AS DOUBLE), (SELECT avg(quality) FROM titanic))')} AS quality, "
    "CASE WHEN n_chars >= 0 AND n_chars < 500 THEN 0.0 WHEN n_chars >= 500 AND n_chars < 2000 THEN 1.0 "
    "WHEN n_chars >= 2000 AND n_chars < 10000 THEN 2.0 WHEN n_chars >= 10000 THEN 3.0 END AS size_bin, lang, "
    "CASE WHEN label IS NULL THEN NULL ELSE CAST(label AS DOUBLE) END AS label FROM titanic",
)
def v27_feature_prep(spark, d):
    """Feature preparation as one Pipeline: mean imputation, bucketing, casts."""
    from lodestar.ml.features import prepare_pipeline

    t = si.titanic(spark, d).select(
        "doc_id", "lang", F.col("quality").cast("double").alias("quality"),
        F.col("n_chars").cast("double").alias("n_chars"), F.col("label").cast("double").alias("label"),
    )
    model = prepare_pipeline(["quality"], "n_chars", SPLITS, "size_bin").fit(t)
    return model.transform(t).select("doc_id", "quality", "size_bin", "lang", "label")


# ---------------------------------------------------------------- A28
@register(
    "a28_density",
    "WITH d AS (SELECT event_type AS g, value AS v FROM events WHERE value IS NOT NULL), "
    "s AS (SELECT g, min(v) AS lo, max(v) AS hi, stddev_samp(v) AS sd, count(*) AS n FROM d GROUP BY g), "
    "b AS (SELECT d.g, least(floor((d.v - s.lo) / greatest(s.hi - s.lo, 1e-12) * 512), 511) AS bb, s.lo, s.hi, s.sd, s.n, count(*) AS c "
    "FROM d JOIN s ON d.g = s.g GROUP BY 1, 2, 3, 4, 5, 6), "
    "k AS (SELECT *, lo + (bb + 0.5) * greatest(hi - lo, 1e-12) / 512 AS center, "
    "greatest(1.06 * coalesce(sd, 0.0) * pow(n, -0.2), 1e-9) AS h FROM b), "
    "grid AS (SELECT k.*, t.i, lo + t.i * (hi - lo) / 63 AS x FROM k, range(0, 64) t(i)) "
    f"SELECT g AS event_type, {r4('x')} AS x, {r4('sum(c * exp(-0.5 * ((x - center) / h) * ((x - center) / h))) / (min(n) * min(h) * sqrt(2 * pi()))')} AS density "
    "FROM grid GROUP BY g, i, x",
)
def a28_density(spark, d):
    """Gaussian kernel density of event value per type on a 64-point grid."""
    return rollups.kernel_density(si.table(spark, d, "events"), "value", by="event_type", grid_points=64, bins=512)


@register("a26_pairwise_p", None)
def a26_pairwise_p(spark, d):
    """Pairwise t tests of delay between carriers with p values and Holm adjustment."""
    return rollups.pairwise_t_tests(si.flights(spark, d), "uniquecarrier", "depdelay")

# ------------------------------------------------- trips by origin and destination
_OD_MEASURES = (
    f"count(*) AS n, {r4('avg(trip_time)')} AS trip_time_mean, {r4('quantile_cont(trip_time, 0.25)')} AS trip_time_p25, "
    f"{r4('quantile_cont(trip_time, 0.5)')} AS trip_time_p50, {r4('quantile_cont(trip_time, 0.75)')} AS trip_time_p75, "
    f"{r4('avg(trip_distance)')} AS trip_dist_mean, {r4('stddev_samp(trip_distance)')} AS trip_dist_sd, "
    f"{r4('avg(pickup_latitude)')} AS pickup_latitude, {r4('avg(pickup_longitude)')} AS pickup_longitude, "
    f"{r4('avg(passenger_count)')} AS passenger_mean, {i8('count(*) FILTER (cab_type_id = \'A\')')} AS yellow_count, "
    f"{i8('count(*) FILTER (cab_type_id = \'R\')')} AS green_count, {i8('count(*) FILTER (cab_type_id = \'N\')')} AS uber_count, "
    f"{r4('avg(fare_amount)')} AS fare_amount, {r4('avg(tip_amount)')} AS tip_amount"
)
_OD_ENDS = f"{r4('avg(dropoff_latitude)')} AS dropoff_latitude, {r4('avg(dropoff_longitude)')} AS dropoff_longitude"
_OD_SQL = (
    ", t AS (SELECT *, hour(pickup_datetime) AS pickup_hour, floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime)) AS trip_time "
    "FROM trips WHERE pickup_gid IS NOT NULL) "
)


@register(
    "v13_od_rollups",
    W(si.TRIPS_SQL)
    + _OD_SQL
    + f"SELECT 'od_hour' AS grain, {i8('pickup_gid')} AS pickup_gid, {i8('dropoff_gid')} AS dropoff_gid, {i8('pickup_hour')} AS pickup_hour, {_OD_MEASURES}, {_OD_ENDS} "
    "FROM t WHERE dropoff_gid IS NOT NULL GROUP BY pickup_gid, dropoff_gid, pickup_hour "
    f"UNION ALL SELECT 'od', {i8('pickup_gid')}, {i8('dropoff_gid')}, NULL, {_OD_MEASURES}, {_OD_ENDS} "
    "FROM t WHERE dropoff_gid IS NOT NULL GROUP BY pickup_gid, dropoff_gid "
    f"UNION ALL SELECT 'origin', {i8('pickup_gid')}, NULL, NULL, {_OD_MEASURES}, NULL, NULL FROM t GROUP BY pickup_gid",
)
def v13_od_rollups(spark, d):
    """Seventeen trip measures by origin-destination-hour, origin-destination and origin."""
    from lodestar.plans import jobs

    return jobs.od_rollups(si.trips(spark, d))


@register(
    "v09_od_profile",
    W(si.TRIPS_SQL)
    + _OD_SQL
    + f"SELECT {i8('pickup_hour')} AS pickup_hour, count(*) AS n, {r4('avg(trip_time)')} AS trip_time_mean, "
    + ", ".join(f"{r4(f'quantile_cont(trip_time, 0.{p})')} AS trip_time_p{p}" for p in (10, 25, 50, 75, 90))
    + " FROM t WHERE pickup_gid = 3 AND dropoff_gid = 7 GROUP BY pickup_hour",
)
def v09_od_profile(spark, d):
    """Trip time of one origin-destination pair by hour: n, mean, five percentiles."""
    from lodestar.plans import jobs

    return jobs.od_trip_profile(si.trips(spark, d), 3, 7)


@register(
    "v24_tips_by_payment",
    W(si.TRIPS_SQL)
    + f"SELECT payment_type, count(*) AS n, {r4('avg(tip_amount)')} AS tip_amount, {r4('avg(fare_amount)')} AS fare_amount, "
    f"{r4('avg(tip_amount) / avg(fare_amount)')} AS tip_percent FROM trips WHERE tip_amount > 0 AND tip_amount < 2500 GROUP BY payment_type",
)
def v24_tips_by_payment(spark, d):
    """Tips by payment type within an open range of tips, with the number of trips."""
    from lodestar.plans import jobs

    return jobs.tips_by_payment(si.trips(spark, d), (0, 2500))


# ------------------------------------------------------------- NULL group keys
_NULL_KEY = f", g AS (SELECT {i8('label')} AS label, CAST(n_chars AS DOUBLE) AS n_chars, doc_id FROM titanic) "


def _null_key(spark, d):
    return si.titanic(spark, d).select(F.col("label").cast("long").alias("label"), F.col("n_chars").cast("double").alias("n_chars"), "doc_id")


@register("w03_rank_null_key", W(si.TITANIC_SQL) + _NULL_KEY + f"SELECT doc_id, label, rank() OVER (PARTITION BY label ORDER BY n_chars DESC) AS rank FROM g")
def w03_rank_null_key(spark, d):
    """Rank within groups, one of which has a NULL key."""
    return windows.rank_within(_null_key(spark, d), "n_chars", "label").select("doc_id", "label", "rank")


@register(
    "w04_extremes_null_key",
    W(si.TITANIC_SQL) + _NULL_KEY + f"SELECT doc_id, label, {r4('n_chars')} AS n_chars FROM g QUALIFY n_chars = min(n_chars) OVER (PARTITION BY label) OR n_chars = max(n_chars) OVER (PARTITION BY label)",
)
def w04_extremes_null_key(spark, d):
    """Rows at their group's least or largest value, one group with a NULL key."""
    return windows.extremes(_null_key(spark, d), "n_chars", "label").select("doc_id", "label", "n_chars")


@register("w05_ntile_null_key", W(si.TITANIC_SQL) + _NULL_KEY + "SELECT doc_id, label, ntile(7) OVER (PARTITION BY label ORDER BY n_chars, doc_id) AS tile FROM g")
def w05_ntile_null_key(spark, d):
    """Tiles within groups, one of which has a NULL key."""
    return windows.ntile(_null_key(spark, d), 7, [F.col("n_chars"), F.col("doc_id")], by="label").select("doc_id", "label", "tile")


@register(
    "v09_profile_null_key",
    W(si.TITANIC_SQL) + _NULL_KEY + f"SELECT label, count(*) AS n, {r4('avg(n_chars)')} AS mean, {r4('quantile_cont(n_chars, 0.1)')} AS p10, {r4('quantile_cont(n_chars, 0.5)')} AS p50, {r4('quantile_cont(n_chars, 0.9)')} AS p90 FROM g GROUP BY label",
)
def v09_profile_null_key(spark, d):
    """Distributed exact percentiles per group, one group with a NULL key."""
    return rollups.profile(_null_key(spark, d), "label", "n_chars", (0.1, 0.5, 0.9), method="distributed")


@register(
    "a25_box_null_key",
    W(si.TITANIC_SQL)
    + _NULL_KEY
    + ", q AS (SELECT label, quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM g GROUP BY label) "
    f"SELECT g.label, count(*) AS n, {r4('min(q1)')} AS q1, {r4('min(q3)')} AS q3, "
    f"{i8('count(*) FILTER (n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1))')} AS n_outliers "
    "FROM g JOIN q ON g.label IS NOT DISTINCT FROM q.label GROUP BY g.label",
)
def a25_box_null_key(spark, d):
    """Box statistics per group, one group with a NULL key."""
    return rollups.box_stats(_null_key(spark, d), "label", "n_chars").select("label", "n", "q1", "q3", "n_outliers")


@register(
    "w07_cumulative_null",
    W(si.TITANIC_SQL) + _NULL_KEY + f"SELECT doc_id, {i8('sum(label) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)')} AS cum FROM g",
)
def w07_cumulative_null(spark, d):
    """Running sum over rows of which many are NULL."""
    return windows.cumulative_sum(_null_key(spark, d), [F.col("doc_id")], "label", "cum").select("doc_id", "cum")


# ------------------------------------------------------------- sources and sinks
_ORDERS = (
    f"SELECT {i8('o_orderkey')} AS o_orderkey, {i8('o_custkey')} AS o_custkey, o_orderstatus, {r4('o_totalprice')} AS o_totalprice, "
    f"{day_text('o_orderdate')} AS day, {i8('year(o_orderdate)')} AS year FROM orders"
)
_ORDERS_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, day date, year int"


def _orders(spark, d):
    return si.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("year")
    )


def _written(spark) -> str:
    """A folder of its own under the shared checkpoint folder."""
    import uuid

    from lodestar.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"


@register("s01_parquet", _ORDERS)
def s01_parquet(spark, d):
    """Orders written as Parquet and read back under a name."""
    from lodestar.sources import files

    path = _written(spark)
    files.write_parquet(_orders(spark, d), path)
    return files.read_parquet(spark, path)


@register("s02_csv", _ORDERS)
def s02_csv(spark, d):
    """Orders written as CSV with a header and read back with a declared schema."""
    from lodestar.sources import files

    path = _written(spark)
    files.write_csv(_orders(spark, d), path)
    return files.read_csv(spark, path, _ORDERS_SCHEMA)


@register("s03_json", _ORDERS)
def s03_json(spark, d):
    """Orders written as JSON lines and read back with a declared schema."""
    from lodestar.sources import files

    path = _written(spark)
    files.write_json(_orders(spark, d), path)
    return files.read_json(spark, path, _ORDERS_SCHEMA)


@register("s08_landing", _ORDERS + " WHERE year(o_orderdate) = 1996")
def s08_landing(spark, d):
    """A CSV fact table landed as Parquet by year, one year read back."""
    from lodestar.sources import files

    path = _written(spark)
    files.write_csv(_orders(spark, d), path)
    return files.land_csv_as_parquet(spark, path, f"{path}-landed", _ORDERS_SCHEMA, ["year"]).where(F.col("year") == 1996)


@register("s27_typed_codes", _ORDERS)
def s27_typed_codes(spark, d):
    """CSV read by one-letter column types."""
    from lodestar.sources import files

    path = _written(spark)
    files.write_csv(_orders(spark, d), path)
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "day", "year"]
    return files.read_csv(spark, path, files.schema_from_codes(names, "iicdDi"))


@register("s14_bucketed_table", _ORDERS)
def s14_bucketed_table(spark, d):
    """Orders saved as a table in buckets of the customer key, cached by its qualified name and read back."""
    import uuid

    from lodestar.sources import catalog

    name = f"default.orders_{uuid.uuid4().hex}"
    catalog.save_table(_orders(spark, d), name, bucket_by=(8, ["o_custkey"]), sort_by=["o_custkey"])
    return catalog.cache_table(spark, name)


@register(
    "s16_sql_parameters",
    f"SELECT o_orderstatus, count(*) AS n, {r4('sum(o_totalprice)')} AS total FROM orders WHERE year(o_orderdate) = 1997 AND o_totalprice > 1000 GROUP BY o_orderstatus",
)
def s16_sql_parameters(spark, d):
    """SQL with bound parameters over a registered view."""
    import uuid

    from lodestar.sources import catalog

    name = f"orders_{uuid.uuid4().hex}"
    catalog.register(_orders(spark, d), name)
    text = f"SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM {name} WHERE year = :year AND o_totalprice > :least GROUP BY o_orderstatus"
    return catalog.sql(spark, text, {"year": 1997, "least": 1000})


@register(
    "s05_yearly_landing",
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) FILTER (WHERE o_orderstatus <> 'P') AS n, "
    f"count(*) FILTER (WHERE o_orderstatus = 'P') AS n_aside, {r4("sum(o_totalprice) FILTER (WHERE o_orderstatus <> 'P')")} AS total FROM orders GROUP BY 1",
)
def s05_yearly_landing(spark, d):
    """Compressed yearly CSV files landed by the year in their names, one year twice; rows with a broken customer number are set aside."""
    from lodestar.sources import landing

    path = _written(spark)
    broken = F.when(F.col("o_orderstatus") == "P", F.lit("no number")).otherwise(F.col("o_custkey").cast("string"))
    orders = _orders(spark, d).withColumn("o_custkey", broken)
    orders.write.partitionBy("year").option("header", True).option("compression", "bzip2").csv(f"{path}/files")
    schema, pattern = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, day date", r"/year=(\d{4})/"
    landing.land_years(spark, f"{path}/files", f"{path}/landed", schema, year_pattern=pattern)
    done = landing.land_years(spark, f"{path}/files/year=1996", f"{path}/landed", schema, year_pattern=pattern)
    totals = done.rows().groupBy("year").agg(F.sum("o_totalprice").alias("total"))
    return done.counts().join(totals, "year")


@register(
    "s22_orc_decimal",
    f"SELECT {i8('o_custkey')} AS o_custkey, count(*) AS n, {r4('sum(CAST(o_totalprice AS DECIMAL(12,2)))')} AS total, "
    f"{r4('min(CAST(o_totalprice AS DECIMAL(12,2)))')} AS least, {r4('max(CAST(o_totalprice AS DECIMAL(12,2)))')} AS most FROM orders GROUP BY o_custkey",
)
def s22_orc_decimal(spark, d):
    """Orders with exact decimal prices in an ORC table bucketed by customer, summed without a shuffle."""
    import uuid

    from lodestar.sources import catalog

    name = f"default.orders_orc_{uuid.uuid4().hex}"
    priced = _orders(spark, d).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    catalog.save_table(priced, name, bucket_by=(8, ["o_custkey"]), sort_by=["o_custkey"], fmt="orc")
    price = F.col("o_totalprice")
    return spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("total"), F.min(price).alias("least"), F.max(price).alias("most"))


@register(
    "s21_external_recovery",
    f"SELECT {i8('year(o_orderdate)')} AS year, {i8('c_nationkey')} AS c_nationkey, count(*) AS n, {r4('sum(o_totalprice)')} AS total "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def s21_external_recovery(spark, d):
    """External tables over a growing Parquet folder and over delimited text with header lines, joined by their statistics."""
    import uuid

    from lodestar.sources import external

    path, tag = _written(spark), uuid.uuid4().hex
    orders, columns = _orders(spark, d), "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, day date, year int"
    orders.where("year < 1995").write.partitionBy("year").parquet(f"{path}/orders")
    external.external_table(spark, f"default.ext_orders_{tag}", columns, f"{path}/orders", partition_by=["year"])
    orders.where("year >= 1995").write.mode("append").partitionBy("year").parquet(f"{path}/orders")
    grown = external.recover(spark, f"default.ext_orders_{tag}")
    si.table(spark, d, "customer").select("c_custkey", "c_nationkey").write.option("header", True).option("sep", "|").csv(f"{path}/customer")
    known = external.external_table(spark, f"default.ext_customer_{tag}", "c_custkey long, c_nationkey long", f"{path}/customer", "csv", options={"header": "true", "sep": "|"})
    external.analyze(spark, f"default.ext_orders_{tag}", ["o_custkey", "year"])
    external.analyze(spark, f"default.ext_customer_{tag}", ["c_custkey"])
    joined = grown.join(known, grown["o_custkey"] == known["c_custkey"])
    return joined.groupBy("year", "c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@register("s13_materialise", _ORDERS)
def s13_materialise(spark, d):
    """Orders computed once into the shared folder under a name, then read by it."""
    import uuid

    from lodestar.sources import catalog

    name = f"orders_{uuid.uuid4().hex}"
    catalog.materialise(_orders(spark, d), name)
    return catalog.table(spark, name)


_BAYES_SQL = ", known AS (SELECT CAST(label AS BIGINT) AS class, n_chars / 1000.0 AS thousands, CAST(quality AS DOUBLE) AS quality FROM lab WHERE label IS NOT NULL AND n_chars IS NOT NULL AND quality IS NOT NULL) "


@register(
    "m10_gaussian_bayes",
    W(si.TITANIC_SQL) + _LABELLED_SQL + _BAYES_SQL
    + " UNION ALL ".join(
        f"SELECT {i8('class')} AS class, '{c}' AS feature, {r4(f'avg({c})')} AS mean, {r4(f'var_pop({c})')} AS variance, "
        f"{r4('ln(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM known))')} AS log_prior FROM known GROUP BY class"
        for c in ("thousands", "quality")
    ),
)
def m10_gaussian_bayes(spark, d):
    """Class means, variances and priors of a Gaussian naive Bayes fit."""
    from lodestar.ml import models

    lab = _labelled(spark, d).select("label", (F.col("n_chars") / 1000.0).alias("thousands"), F.col("quality").cast("double").alias("quality"))
    return models.gaussian_bayes(lab, ["thousands", "quality"], "label")


@register(
    "m25_pca_two",
    "WITH m AS (SELECT var_samp(l_quantity) AS a, var_samp(l_extendedprice / 1000.0) AS b, covar_samp(l_quantity, l_extendedprice / 1000.0) AS c FROM lineitem), "
    "e AS (SELECT a + b AS total, sqrt((a - b) * (a - b) + 4 * c * c) AS gap FROM m) "
    f"SELECT {i8('1')} AS component, {r4('(total + gap) / (2 * total)')} AS explained_variance FROM e "
    f"UNION ALL SELECT {i8('2')} AS component, {r4('(total - gap) / (2 * total)')} AS explained_variance FROM e",
)
def m25_pca_two(spark, d):
    """Explained variance of two principal components, whose closed form SQL has."""
    from pyspark.ml.feature import VectorAssembler

    from lodestar.ml import models

    lines = si.table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("quantity"), (F.col("l_extendedprice") / 1000.0).cast("double").alias("price"))
    vectors = VectorAssembler(inputCols=["quantity", "price"], outputCol="features").transform(lines)
    return models.pca(vectors, "features", 2)[1]


@register(
    "m30_saved_model",
    W(si.FLIGHTS_SQL)
    + ", g AS (SELECT year, depdelay, depdelay - arrdelay AS gain FROM flights), "
    "fit AS (SELECT regr_slope(gain, depdelay) AS b, regr_intercept(gain, depdelay) AS a FROM g WHERE year <= 1998) "
    f"SELECT {i8('year')} AS year, count(*) AS n, {r4('avg(gain)')} AS mean_actual, {r4('avg(fit.a + fit.b * depdelay)')} AS mean_pred FROM g, fit WHERE year > 1998 GROUP BY year",
)
def m30_saved_model(spark, d):
    """Gain model saved to the shared folder, loaded again and scored on later years."""
    import uuid

    from lodestar.ml import models
    from lodestar.ml.features import training_table
    from lodestar.session import checkpoint_dir

    g = training_table(si.flights(spark, d).select("year", "depdelay", (F.col("depdelay") - F.col("arrdelay")).alias("gain")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/gain-model-{uuid.uuid4().hex}"
    models.save(models.fit_regressor(g.where(F.col("year") <= 1998), "gain ~ depdelay", "linear"), path)
    scored = models.load(path).transform(g.where(F.col("year") > 1998))
    return scored.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.avg("gain").alias("mean_actual"), F.avg("prediction").alias("mean_pred"))


_STATUS_ROWS = [("O", "open"), ("F", "filled"), ("P", None), (None, "unknown")]


@register(
    "s18_ddl_insert",
    "WITH s(code, meaning) AS (VALUES ('O', 'open'), ('F', 'filled'), ('P', NULL), (NULL, 'unknown')), "
    "u(priority, urgent) AS (VALUES ('1-URGENT', 'yes'), ('2-HIGH', 'yes')) "
    f"SELECT meaning, coalesce(urgent, 'no') AS urgent, count(o_orderkey) AS n, {r4('sum(o_totalprice)')} AS total "
    "FROM s LEFT JOIN orders ON o_orderstatus = code LEFT JOIN u ON priority = o_orderpriority GROUP BY 1, 2",
)
def s18_ddl_insert(spark, d):
    """A database and a table of literal rows with NULLs, joined with orders and uploaded rows, then dropped."""
    import uuid

    from lodestar.sources import catalog

    mark = uuid.uuid4().hex
    catalog.create_database(spark, f"codes_{mark}")
    catalog.create_table(spark, f"codes_{mark}.status", "code STRING, meaning STRING")
    catalog.insert_rows(spark, f"codes_{mark}.status", _STATUS_ROWS)
    urgent = catalog.upload(spark, [("1-URGENT", "yes"), ("2-HIGH", "yes")], "priority string, urgent string")
    orders = si.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderpriority").alias("priority"))
    joined = catalog.table(spark, f"codes_{mark}.status").join(orders, F.col("o_orderstatus") == F.col("code"), "left").join(urgent, "priority", "left")
    out = catalog.materialise(
        joined.groupBy("meaning", F.coalesce("urgent", F.lit("no")).alias("urgent")).agg(F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("total"))
    )
    catalog.drop_table(spark, f"codes_{mark}.status")
    catalog.sql(spark, f"DROP DATABASE IF EXISTS codes_{mark}")
    return out


@register(
    "s20_quoted_csv",
    f"""SELECT {i8('c_custkey')} AS c_custkey, c_name || ', "' || c_mktsegment || '"' AS label FROM customer""",
)
def s20_quoted_csv(spark, d):
    """Labels with separators and quotes in them through an external table of quoted text."""
    import uuid

    from lodestar.session import checkpoint_dir
    from lodestar.sources import catalog

    name = f"customers_{uuid.uuid4().hex}"
    options = {"sep": ",", "quote": '"', "escape": '"'}
    catalog.create_table(spark, name, "c_custkey BIGINT, label STRING", "csv", f"{checkpoint_dir(spark).rstrip('/')}/{name}", options)
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("label")
    si.table(spark, d, "customer").select(F.col("c_custkey").cast("long"), label).write.insertInto(name)
    spark.catalog.refreshTable(name)
    return catalog.table(spark, name)

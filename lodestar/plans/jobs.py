"""Named analyses (V09-V27) composed from the operators.

Inputs are DataFrames with the column names of the original analyses
(trips / flights / names / relays); ``standins`` maps the driver tables
onto them.  Each job is one lazy plan; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.defaults import (
    GAIN_ARRIVAL_DELAY,
    GAIN_DEPARTURE_DELAY,
    GAIN_YEARS,
    NETWORK_MIN_FLIGHTS,
    PROFILE_PROBABILITIES,
    TAIL_MAX_DISTANCE,
    TAIL_MIN_FLIGHTS,
    TIP_RANGE,
    TOP_DESTINATIONS,
    TOP_NAMES_RANK_BELOW,
    VERSION_PREFIX,
)
from lodestar.functions import scalar as fx
from lodestar.operators import geo, joins, rollups, verbs, windows
from lodestar.session import reliable_checkpoint

PAY_DOMAIN = {"credit": ["1-URGENT", "2-HIGH"], "cash": ["3-MEDIUM"]}
CAB_TYPES = {"A": "yellow", "R": "green"}
UBER = "N"


def top_destinations(trips: DataFrame, k: int = TOP_DESTINATIONS, origin: str = "pickup_gid", dest: str = "dropoff_gid") -> DataFrame:
    """Eight measures per (origin, destination), destinations with rank <= k by trips
    inside each origin, ties kept (V11)."""
    m = rollups.summarize(
        trips, [origin, dest],
        {
            "n": F.count(F.lit(1)),
            "mean_distance": F.avg("trip_distance"),
            "mean_fare": F.avg("fare_amount"),
            "mean_tip": F.avg("tip_amount"),
            "mean_total": F.avg("total_amount"),
            "mean_passengers": F.avg("passenger_count"),
            "mean_days": F.avg(fx.seconds_between("pickup_datetime", "dropoff_datetime") / F.lit(86400.0)),
            "tip_pct": F.try_divide(F.avg("tip_amount"), F.avg("fare_amount")),
        },
    )
    return windows.top_k_with_ties(m, "n", k, by=origin)


def trip_enrichment(trips: DataFrame, areas: DataFrame) -> DataFrame:
    """Null and code filters, decoded cab and payment types, residual amount and the
    area lookup in two roles; fixed 20-column projection (V12)."""
    t = verbs.drop_missing(trips, ["pickup_gid", "dropoff_gid", "fare_amount"])
    t = verbs.in_list(t, "cab_type_id", list(CAB_TYPES))
    t = t.withColumns(
        {
            "cab_type": verbs.recode_when("cab_type_id", CAB_TYPES),
            "pay_type": verbs.normalise_codes("payment_type", PAY_DOMAIN),
            "other_amount": F.col("total_amount") - F.col("fare_amount") - F.col("tip_amount"),
            "trip_seconds": fx.seconds_between("pickup_datetime", "dropoff_datetime"),
            "pickup_year": F.year("pickup_datetime"),
        }
    )
    t = joins.role_join(
        t, areas, "gid", {"pickup": "pickup_gid", "dropoff": "dropoff_gid"}, {"boroname": "boro", "ntaname": "nta"}
    )
    return t.select(
        "order_id", "pickup_datetime", "pickup_gid", "pickup_boro", "pickup_nta",
        "dropoff_datetime", "dropoff_gid", "dropoff_boro", "dropoff_nta", "cab_type",
        "vendor_id", "passenger_count", "trip_distance", "pay_type", "fare_amount",
        "tip_amount", "other_amount", "total_amount", "trip_seconds", "pickup_year",
    )


def gain_model_data(
    flights: DataFrame,
    airlines: DataFrame,
    delay_range=GAIN_DEPARTURE_DELAY,
    years=GAIN_YEARS,
    arrival_range=GAIN_ARRIVAL_DELAY,
) -> DataFrame:
    """Null filter, strict delay ranges, closed year range, carrier description, gain."""
    f = verbs.drop_missing(flights, ["depdelay", "arrdelay", "distance"])
    f = verbs.where_all(
        f,
        fx.strict_between("depdelay", *delay_range),
        fx.strict_between("arrdelay", *arrival_range),
        F.col("year").between(*years),
    )
    f = joins.lookup_join(f, airlines, {"uniquecarrier": "code"}, how="left")
    return f.withColumn("gain", F.col("depdelay") - F.col("arrdelay"))


def carrier_summary(gain_data: DataFrame) -> DataFrame:
    """Per carrier: flights, mean delays, distance and gain, description (V15); sorted by gain."""
    return rollups.summarize(
        gain_data, "uniquecarrier",
        {
            "n": F.count(F.lit(1)),
            "mean_depdelay": F.avg("depdelay"),
            "mean_arrdelay": F.avg("arrdelay"),
            "mean_gain": F.avg("gain"),
            "mean_distance": F.avg("distance"),
            "description": F.min("description"),
        },
    ).orderBy("mean_gain")


def route_summary(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Scored flights rolled up by origin, destination, carrier and its description."""
    scored = scored.withColumnsRenamed({"uniquecarrier": "carrier", "description": "airline"})
    return rollups.summarize(
        scored, ["origin", "dest", "carrier", "airline"],
        {
            "flights": F.count(F.lit(1)),
            "distance": F.avg("distance"),
            "avg_dep_delay": F.avg("depdelay"),
            "avg_arr_delay": F.avg("arrdelay"),
            "avg_gain": F.avg("gain"),
            "pred_gain": F.avg(prediction),
        },
    )


def great_circle_routes(flights: DataFrame, airports: DataFrame, n: int = 10) -> DataFrame:
    """Great-circle paths of every route."""
    routes = flights.select("origin", "dest").distinct()
    ends = geo.route_ends(routes, airports, "origin", "dest", "faa")
    return geo.great_circle_points(ends, n).select("origin", "dest", "step", "lat", "lon")


def carrier_network(flights: DataFrame, airports: DataFrame, year: int, carrier: str, min_flights: int = NETWORK_MIN_FLIGHTS) -> DataFrame:
    """Routes of one carrier in one year with more than ``min_flights`` flights, a colour
    index ``round(n / max(n) * 100)`` and both end coordinates, sorted by flights (V18)."""
    chosen = flights.where((F.col("year") == year) & (F.col("uniquecarrier") == carrier))
    # a small table that is read twice (rows and largest count): kept
    routes = reliable_checkpoint(rollups.group_count(chosen, ["origin", "dest"]).where(F.col("n") > min_flights))
    routes = routes.withColumn(
        "colour", fx.round_half_up(F.col("n") / fx.scalar_of(routes, F.max("n")) * F.lit(100), 0)
    )
    return geo.route_ends(routes, airports, "origin", "dest", "faa").orderBy("n", "origin", "dest")


def tail_profile(flights: DataFrame, min_flights: int = TAIL_MIN_FLIGHTS, max_distance: float = TAIL_MAX_DISTANCE) -> DataFrame:
    """Per aircraft: flights, mean distance and delays; busy, short-haul ones with a known delay only."""
    return rollups.summarize(
        flights, "tailnum",
        {
            "n": F.count(F.lit(1)),
            "dist": F.avg("distance"),
            "delay": F.avg("arrdelay"),
            "depdelay": F.avg("depdelay"),
        },
    ).where((F.col("n") > min_flights) & (F.col("dist") < max_distance) & F.col("delay").isNotNull())


def top_names_trend(names: DataFrame, year: int, k: int = TOP_NAMES_RANK_BELOW - 1) -> DataFrame:
    """Names with rank <= k by count per sex in ``year``, and their totals in every year."""
    in_year = rollups.summarize(names.where(F.col("year") == year), ["sex", "name"], {"total": F.sum("n")})
    top = windows.top_k_with_ties(in_year, "total", k, by="sex").select("sex", "name")
    trend = joins.semi_join(names, top, ["sex", "name"])
    return rollups.summarize(trend, ["year", "sex", "name"], {"total": F.sum("n")})


def shared_names(names: DataFrame, threshold: float) -> DataFrame:
    """Names used by both sexes above ``threshold`` each, with the count-weighted mean year."""
    sums = names.groupBy("name").agg(
        F.sum(F.when(F.col("sex") == "F", F.col("n")).otherwise(0)).alias("female"),
        F.sum(F.when(F.col("sex") == "M", F.col("n")).otherwise(0)).alias("male"),
        fx.round_half_up(F.try_divide(F.sum(F.col("year") * F.col("n")), F.sum("n")), 0).alias("mean_year"),
    )
    return sums.where((F.col("female") > threshold) & (F.col("male") > threshold))


def births_by_year(names: DataFrame, scale: float = 1_000_000) -> DataFrame:
    """Counts per year and sex in units of ``scale``."""
    return rollups.class_sums(names, "year", "sex", ["F", "M"], value=F.col("n") / F.lit(scale))


def daily_series(
    relays: DataFrame,
    since: str,
    platforms: Sequence[str],
    flags: Sequence[str],
    versions: Sequence[str],
) -> DataFrame:
    """Daily totals and per-platform, per-flag and per-version relay sums as one wide
    table from one scan (V23, F12, F16, A17, A18).  NULL flags count in the total only;
    versions are relabelled ``^0`` -> ``v0``."""
    r = relays.where(F.col("date") >= F.to_date(F.lit(since)))
    r = r.withColumn("version", F.regexp_replace("version", *VERSION_PREFIX))
    cols = [F.sum("relays").alias("total")]
    cols += [F.sum(F.when(F.col("platform") == p, F.col("relays"))).alias(p) for p in platforms]
    cols += [F.sum(F.when(F.col("flag") == f, F.col("relays"))).alias(f"flag_{f}") for f in flags]
    cols += [
        F.sum(F.when(F.col("version") == v, F.col("relays"))).alias("version_" + v.replace(".", "_"))
        for v in versions
    ]
    return r.groupBy("date").agg(*cols)


def trips_by_year(trips: DataFrame) -> DataFrame:
    """Trips per pickup year."""
    return rollups.group_count(trips, F.year("pickup_datetime").alias("year"))


def mean_fare_at(trips: DataFrame, hour: int) -> DataFrame:
    """Mean fare of the trips picked up in one hour of day chosen at run time."""
    return rollups.summarize(trips.where(F.hour("pickup_datetime") == F.lit(hour)), None, {"fare_amount": F.avg("fare_amount")})


def tips_by_payment(trips: DataFrame, tip_range=TIP_RANGE) -> DataFrame:
    """Per payment type: trips, mean tip and fare and their ratio, tips strictly within a range."""
    means = rollups.summarize(
        trips.where(fx.strict_between("tip_amount", *tip_range)), "payment_type",
        {"n": F.count(F.lit(1)), "tip_amount": F.avg("tip_amount"), "fare_amount": F.avg("fare_amount")},
    )
    return means.withColumn("tip_percent", F.try_divide("tip_amount", "fare_amount"))


def od_rollups(trips: DataFrame, origin: str = "pickup_gid", dest: str = "dropoff_gid") -> DataFrame:
    """Seventeen measures at the grains origin-destination-hour, origin-destination and origin.

    The trips are read twice: for the means and counts, and for the counts of
    each trip time, from which the percentiles are taken.  Trips without a destination count at the origin grain only; there the
    destination's coordinates have no meaning and are NULL.
    """
    t = trips.where(F.col(origin).isNotNull()).withColumns(
        {"pickup_hour": F.hour("pickup_datetime"), "trip_time": fx.seconds_between("pickup_datetime", "dropoff_datetime")}
    )
    measures = {
        "n": F.count(F.lit(1)),
        "trip_time_mean": F.avg("trip_time"),
        "trip_dist_mean": F.avg("trip_distance"),
        "trip_dist_sd": F.stddev_samp("trip_distance"),
        **{c: F.avg(c) for c in ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")},
        "passenger_mean": F.avg("passenger_count"),
        **{f"{cab}_count": F.sum(F.when(F.col("cab_type_id") == code, 1).otherwise(0)) for code, cab in CAB_TYPES.items()},
        "uber_count": F.sum(F.when(F.col("cab_type_id") == UBER, 1).otherwise(0)),
        "fare_amount": F.avg("fare_amount"),
        "tip_amount": F.avg("tip_amount"),
    }
    finest = [origin, dest, "pickup_hour"]
    grains = {"od_hour": finest, "od": [origin, dest], "origin": [origin]}
    means = rollups.grain_rollup(t, grains, measures)
    # percentiles from narrow rows of their own: beside the means every row, once per grain, would be sorted in the map tasks
    times = rollups.group_count(t, [*finest, "trip_time"], "__c")
    quartiles = (0.25, 0.5, 0.75)
    found = rollups.grain_rollup(times, grains, {"__q": F.percentile("trip_time", F.array(*map(F.lit, quartiles)), F.col("__c"))})
    at_origin = F.col("grain") == "origin"
    means, found = (x.where(at_origin | F.col(dest).isNotNull()) for x in (means, found))
    out = joins.null_safe_join(means, found, [*finest, "grain"])
    columns = []
    for c in means.columns:
        columns.append(F.when(~at_origin, F.col(c)).alias(c) if c in ("dropoff_latitude", "dropoff_longitude") else F.col(c))
        if c == "trip_time_mean":
            columns += [F.col("__q")[i].alias(f"trip_time_p{int(p * 100)}") for i, p in enumerate(quartiles)]
    return out.select(*columns)


def od_trip_profile(trips: DataFrame, origin: int, dest: int, probs: Sequence[float] = PROFILE_PROBABILITIES) -> DataFrame:
    """Trip time of one origin-destination pair by hour of pickup: n, mean, percentiles."""
    chosen = trips.where((F.col("pickup_gid") == origin) & (F.col("dropoff_gid") == dest))
    out = rollups.profile(chosen, F.hour("pickup_datetime").alias("pickup_hour"), fx.seconds_between("pickup_datetime", "dropoff_datetime"), probs)
    return out.withColumnsRenamed({c: f"trip_time_{c}" for c in out.columns if c not in ("pickup_hour", "n")})


def save_route_lookup(summary: DataFrame, table: str, buckets: int = 64) -> None:
    """Persist the route summary bucketed and sorted by origin (V16, S14): a point
    lookup on an origin then reads one bucket file per table file, not the table."""
    from lodestar.sources.catalog import save_table

    save_table(summary, table, bucket_by=(buckets, ["origin"]), sort_by=["origin", "dest"])


def serve_route(spark, table: str, origin, dest=None, carrier: str | None = None) -> DataFrame:
    """Point filters on the saved route table (V16): origin, optionally dest and carrier."""
    t = spark.table(table).where(F.col("origin") == F.lit(origin))
    if dest is not None:
        t = t.where(F.col("dest") == F.lit(dest))
    if carrier is not None:
        t = t.where(F.col("carrier") == F.lit(carrier))
    return t

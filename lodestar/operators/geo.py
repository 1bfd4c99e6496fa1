"""Great-circle paths (V17) and route end lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route_ends(routes: DataFrame, places: DataFrame, origin: str, dest: str, key: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Attach coordinates of both ends; routes with an unknown end are dropped."""
    p = places.select(key, lat, lon)
    o = p.select(F.col(key).alias("__o"), F.col(lat).alias("lat1"), F.col(lon).alias("lon1"))
    d = p.select(F.col(key).alias("__d"), F.col(lat).alias("lat2"), F.col(lon).alias("lon2"))
    return (routes.join(o, routes[origin] == o["__o"], "inner").drop("__o")
            .join(d, F.col(dest) == d["__d"], "inner").drop("__d"))


def great_circle_points(df: DataFrame, n: int = 50, lat1: str = "lat1", lon1: str = "lon1", lat2: str = "lat2", lon2: str = "lon2") -> DataFrame:
    """``n`` intermediate points plus both ends on the great circle of every row.

    Spherical linear interpolation in Column math; adds ``step`` (0..n+1),
    ``lat`` and ``lon`` in degrees.  Equal end points repeat that point;
    antipodal ends have no unique circle and give NULL coordinates.
    """
    r = F.radians
    p1, l1, p2, l2 = r(F.col(lat1)), r(F.col(lon1)), r(F.col(lat2)), r(F.col(lon2))
    # central angle by the haversine form (stable for short distances)
    hav = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    d = F.lit(2.0) * F.asin(F.sqrt(F.least(hav, F.lit(1.0))))
    out = df.withColumn("__d", d).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n + 1))))
    f = F.col("step") / F.lit(float(n + 1))
    sd = F.sin(F.col("__d"))
    a = F.when(F.col("__d") == 0, F.lit(1.0) - f).otherwise(F.try_divide(F.sin((F.lit(1.0) - f) * F.col("__d")), sd))
    b = F.when(F.col("__d") == 0, f).otherwise(F.try_divide(F.sin(f * F.col("__d")), sd))
    x = a * F.cos(p1) * F.cos(l1) + b * F.cos(p2) * F.cos(l2)
    y = a * F.cos(p1) * F.sin(l1) + b * F.cos(p2) * F.sin(l2)
    z = a * F.sin(p1) + b * F.sin(p2)
    return out.withColumns({
        "lat": F.degrees(F.atan2(z, F.sqrt(x * x + y * y))),
        "lon": F.degrees(F.atan2(y, x)),
    }).drop("__d")

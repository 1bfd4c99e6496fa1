"""Stand-in datasets built from the driver tables.

Each builder returns a lazy DataFrame that reads only the columns a query
uses (Catalyst prunes the joins' inputs), and each has a SQL twin with the
same definition for the DuckDB oracle.  Fact-to-fact joins (lineitem to
orders, orders to customer) are left to Spark's planner: they are shuffle
joins on their keys at scale; Spark broadcasts the nation / region / brand
lookups by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- trips
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips: lineitem x orders x supplier x customer."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    j = (
        li.join(o, li["l_orderkey"] == o["o_orderkey"])
        .join(s, li["l_suppkey"] == s["s_suppkey"])
        .join(c, o["o_custkey"] == c["c_custkey"])
    )
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("s_nationkey").alias("pickup_gid"),
        F.col("c_nationkey").alias("dropoff_gid"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
        (F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax"))).alias("total_amount"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("o_orderstatus").alias("vendor_id"),
        F.col("l_returnflag").alias("cab_type_id"),
        F.col("o_orderpriority").alias("payment_type"),
        *[
            ((F.col(key) * times) % span - shift).cast("double").alias(f"{end}_{axis}")
            for end, key in (("pickup", "s_nationkey"), ("dropoff", "c_nationkey"))
            for axis, times, span, shift in (("latitude", 37, 140, 70), ("longitude", 71, 360, 180))
        ],
    )


TRIPS_SQL = """trips AS (
  SELECT l.l_orderkey AS order_id,
         o.o_orderdate AS pickup_datetime, l.l_shipdate AS dropoff_datetime,
         s.s_nationkey AS pickup_gid, c.c_nationkey AS dropoff_gid,
         l.l_extendedprice AS fare_amount, l.l_extendedprice * l.l_discount AS tip_amount,
         l.l_extendedprice * (1 + l.l_tax) AS total_amount, l.l_quantity AS trip_distance,
         l.l_linenumber AS passenger_count, o.o_orderstatus AS vendor_id,
         l.l_returnflag AS cab_type_id, o.o_orderpriority AS payment_type,
         CAST((s.s_nationkey * 37) % 140 - 70 AS DOUBLE) AS pickup_latitude,
         CAST((s.s_nationkey * 71) % 360 - 180 AS DOUBLE) AS pickup_longitude,
         CAST((c.c_nationkey * 37) % 140 - 70 AS DOUBLE) AS dropoff_latitude,
         CAST((c.c_nationkey * 71) % 360 - 180 AS DOUBLE) AS dropoff_longitude
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""


def nyct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area lookup used in two roles: nation x region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("gid"),
        F.col("n_name").alias("ntaname"),
        F.col("r_name").alias("boroname"),
    )


NYCT_SQL = """nyct AS (
  SELECT n.n_nationkey AS gid, n.n_name AS ntaname, r.r_name AS boroname
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


# -------------------------------------------------------------- flights
def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights: lineitem x part x supplier x orders x customer."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = (
        li.join(p, li["l_partkey"] == p["p_partkey"])
        .join(s, li["l_suppkey"] == s["s_suppkey"])
        .join(o, li["l_orderkey"] == o["o_orderkey"])
        .join(c, o["o_custkey"] == c["c_custkey"])
    )
    return j.select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.dayofmonth("l_shipdate").alias("dayofmonth"),
        F.col("l_linenumber").alias("flightnum"),
        F.col("p_brand").alias("uniquecarrier"),
        F.col("l_partkey").alias("tailnum"),
        F.col("l_quantity").alias("depdelay"),
        F.col("p_size").cast("double").alias("arrdelay"),
        F.col("s_nationkey").alias("origin"),
        F.col("c_nationkey").alias("dest"),
        F.col("p_retailprice").alias("distance"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("cancelled"),
    )


FLIGHTS_SQL = """flights AS (
  SELECT year(l.l_shipdate) AS year, month(l.l_shipdate) AS month, day(l.l_shipdate) AS dayofmonth,
         l.l_linenumber AS flightnum, p.p_brand AS uniquecarrier, l.l_partkey AS tailnum,
         l.l_quantity AS depdelay, CAST(p.p_size AS DOUBLE) AS arrdelay,
         s.s_nationkey AS origin, c.c_nationkey AS dest, p.p_retailprice AS distance,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier lookup (code, description) from the distinct brands."""
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_brand").alias("code"))
        .distinct()
        .withColumn("description", F.concat(F.lit("Carrier "), F.col("code")))
    )


AIRLINES_SQL = """airlines AS (
  SELECT code, 'Carrier ' || code AS description FROM (SELECT DISTINCT p_brand AS code FROM part))"""


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport lookup (faa, name, lat, lon); coordinates follow a fixed rule of the key."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("faa"),
        F.col("n_name").alias("name"),
        ((F.col("n_nationkey") * 37) % 140 - 70).cast("double").alias("lat"),
        ((F.col("n_nationkey") * 71) % 360 - 180).cast("double").alias("lon"),
    )


AIRPORTS_SQL = """airports AS (
  SELECT n_nationkey AS faa, n_name AS name,
         CAST((n_nationkey * 37) % 140 - 70 AS DOUBLE) AS lat,
         CAST((n_nationkey * 71) % 360 - 180 AS DOUBLE) AS lon
  FROM nation)"""


# ------------------------------------------------------------ babynames
def babynames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names: lineitem x part x orders, even order keys F, odd ones M."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    o = table(spark, sf_dir, "orders")
    j = li.join(p, li["l_partkey"] == p["p_partkey"]).join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.year("o_orderdate").alias("year"),
        F.when(F.col("l_orderkey") % 2 == 0, "F").otherwise("M").alias("sex"),
        F.col("p_name").alias("name"),
        F.col("l_quantity").alias("n"),
    )


BABYNAMES_SQL = """babynames AS (
  SELECT year(o.o_orderdate) AS year, CASE WHEN l.l_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
         p.p_name AS name, l.l_quantity AS n
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


# -------------------------------------------------------------- titanic
def titanic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: documents left join labels (unlabelled rows carry NULLs)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, on="doc_id", how="left").select(
        "doc_id", "lang", "source", "n_chars", "quality", F.col("toxic").alias("label")
    )


TITANIC_SQL = """titanic AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# ------------------------------------------------------------------ tor
def tor_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relay counts: events with date, platform, flag (some NULL), version, relays."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("platform"),
        F.when(F.col("user_id") % 3 == 0, "Exit").when(F.col("user_id") % 3 == 1, "Guard").alias("flag"),
        F.concat(F.lit("0."), (F.col("user_id") % 4).cast("string")).alias("version"),
        F.col("value").alias("relays"),
    )


TOR_SQL = """tor AS (
  SELECT CAST(ts AS DATE) AS date, event_type AS platform,
         CASE WHEN user_id % 3 = 0 THEN 'Exit' WHEN user_id % 3 = 1 THEN 'Guard' END AS flag,
         '0.' || CAST(user_id % 4 AS VARCHAR) AS version, value AS relays
  FROM events)"""


def with_sql(*ctes: str) -> str:
    """``WITH`` clause from CTE texts."""
    return "WITH " + ",\n".join(ctes) + "\n"

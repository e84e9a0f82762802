"""Adapters that turn the driver's TPC-H-like tables into the shapes the
pipeline consumes (trip-shaped raw rows, a zone seed, a time-of-day source).

Every adapter is a lazy DataFrame over the given parquet tables, so its
size grows with the tables and Catalyst plans it together with whatever
consumes it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.params import PipelineParams
from farebox.sources.lake import add_partition_columns
from farebox.sources.raw import RAW_COLUMN_NAMES, align_columns

# Fixed values of the trip fixture: its window, its duration bound (the
# reference's 1 .. 1440 minutes scaled by 365 for day-level timestamps),
# the airport nations, and the constant surcharge columns.
FIXTURE_START = dt.date(1996, 1, 1)
FIXTURE_END = dt.date(2001, 1, 1)
FIXTURE_MAX_DURATION_MINUTES = 1440 * 365
FIXTURE_AIRPORTS = ("NATION_1", "NATION_13")
FIXTURE_CONSTANTS = {
    "extra": 0.5,
    "mta_tax": 0.5,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "congestion_surcharge": 2.5,
}
FIXTURE_PARAMS = PipelineParams(
    start=FIXTURE_START, end=FIXTURE_END,
    max_duration_minutes=FIXTURE_MAX_DURATION_MINUTES,
    airport_zones=FIXTURE_AIRPORTS,
)
# Arrival cut-off used to split the fixture into "first load" and "later
# load": a trip record arrives once the trip is over (dropoff time).
FIXTURE_ARRIVAL_CUTOFF = dt.datetime(1998, 6, 1)
# Hour-of-day source: the events table is the file for this stated month.
EVENTS_STATED_MONTHS = ((2024, 1), (2024, 2))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined columns that trips are made of, one row per order line.

    lineitem ⋈ (orders ⋈ customer) ⋈ supplier; Catalyst broadcasts the sides
    under ``autoBroadcastJoinThreshold`` (a size it checks) and sort-merges
    the rest. Orders meet their customers first: where customers are too many
    to broadcast, a few columns of orders are shuffled for them, not every line.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey", "c_custkey")
    return (li.join(placed, li.l_orderkey == placed.o_orderkey)
              .join(s, li.l_suppkey == s.s_suppkey)
              .drop("l_orderkey", "o_orderkey", "l_suppkey", "s_suppkey"))


def land_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Store the joined lines, for jobs that read the trips more than once: the
    joins, and their shuffles, run once. The lines are narrower than the trips
    (amounts are computed, fees are constants)."""
    trip_lines(spark, sf_dir).write.option("compression", "zstd").parquet(path)


def trip_source(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Trip-shaped rows (source spelling, no partition columns) of the joined
    lines (``lines``: those that were landed).

    The duplicate branches are produced in the same pass with one ``explode``
    instead of scanning and joining three times.
    """
    j = trip_lines(spark, sf_dir) if lines is None else lines
    pk = F.col("l_partkey")
    price = F.col("l_extendedprice")
    # 0 = the row itself, 1 = exact duplicate, 2 = same key with another tip.
    # A CASE over literal arrays keeps the generator inside codegen.
    dup, retip = pk % 50 == 0, pk % 75 == 0
    arr = lambda *v: F.array(*[F.lit(x) for x in v])
    variant = F.explode(F.when(dup & retip, arr(0, 1, 2)).when(dup, arr(0, 1))
                         .when(retip, arr(0, 2)).otherwise(arr(0)))
    b = j.select(
        F.col("l_linenumber").alias("VendorID"),
        # some rows have no times, and some ids have no zone
        F.when(pk % 250 != 9, F.col("o_orderdate")).alias("tpep_pickup_datetime"),
        F.when(pk % 200 != 3, F.col("l_shipdate")).alias("tpep_dropoff_datetime"),
        F.when(pk % 20 == 0, F.lit(None)).otherwise(F.col("l_quantity") / 2).alias("passenger_count"),
        ((F.col("l_quantity") - 1) * 5).alias("trip_distance"),
        ((pk % 12).cast("double") / 2).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "N", "N")
         .alias("store_and_fwd_flag"),
        F.when(pk % 90 == 7, F.lit(264)).otherwise(F.col("c_nationkey")).alias("PULocationID"),
        F.when(pk % 90 == 11, F.lit(265)).when(F.col("s_nationkey") != 24, F.col("s_nationkey"))
         .alias("DOLocationID"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise(F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("payment_type"),
        (price - 2000).alias("fare_amount"),
        (price * F.col("l_discount")).alias("tip_amount"),
        ((price - 2000) * (1 + F.col("l_tax")) + price * F.col("l_discount")).alias("total_amount"),
        pk.alias("l_partkey"),
        variant.alias("_variant"),
    )
    b = b.withColumn("tip_amount", F.when(F.col("_variant") == 2, F.col("tip_amount") + 1)
                     .otherwise(F.col("tip_amount"))).drop("_variant")
    # l_partkey stays as an extra source column: alignment drops it
    consts = {k: F.lit(v).cast("double") for k, v in FIXTURE_CONSTANTS.items()}
    # airport fee is absent from this "file": alignment fills it with NULL
    return b.withColumns(consts)


def trip_raw(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Aligned raw rows (21 columns incl. partition columns from the data)."""
    aligned = align_columns(trip_source(spark, sf_dir, lines))
    return add_partition_columns(aligned.drop("year", "month"), "tpep_pickup_datetime") \
        .select(*RAW_COLUMN_NAMES)


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup shaped like the reference's seed: nation ⋈ region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                     F.col("r_name").alias("Borough"),
                     F.col("n_name").alias("Zone"),
                     F.when(F.col("n_regionkey") % 2 == 0, "Boro Zone").otherwise("Yellow Zone")
                      .alias("service_zone")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"

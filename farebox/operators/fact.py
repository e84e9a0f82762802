"""Fact table: keys, exact measures and guarded ratios (P-12, P-13,
P-18..P-20), unknown-member routing (J-03)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import date_key, round_numeric
from farebox.functions.temporal import duration_minutes_2dp, duration_us

UNKNOWN_ID = -1

# Fact columns in output order.
FACT_COLUMNS = (
    "trip_id", "pickup_date_key", "pickup_location_id", "dropoff_location_id",
    "payment_type_id", "vendor_id", "pickup_at", "dropoff_at", "passenger_count",
    "trip_distance_miles", "trip_duration_minutes", "fare_amount", "extra_charges",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "total_amount", "avg_speed_mph",
    "tip_percentage",
)


def to_fact(stg: DataFrame) -> DataFrame:
    """Staging rows -> fact rows. A narrow projection: no shuffle."""
    minutes = F.col("trip_duration_minutes")
    return stg.select(
        "trip_id",
        date_key("pickup_at").alias("pickup_date_key"),
        F.coalesce(F.col("pickup_location_id"), F.lit(UNKNOWN_ID)).alias("pickup_location_id"),
        F.coalesce(F.col("dropoff_location_id"), F.lit(UNKNOWN_ID)).alias("dropoff_location_id"),
        F.coalesce(F.col("payment_type_id"), F.lit(UNKNOWN_ID)).alias("payment_type_id"),
        "vendor_id", "pickup_at", "dropoff_at", "passenger_count", "trip_distance_miles",
        duration_minutes_2dp(duration_us("pickup_at", "dropoff_at")).alias("trip_duration_minutes"),
        "fare_amount", "extra_charges", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
        F.when(minutes > 0, round_numeric(F.col("trip_distance_miles") / (minutes / F.lit(60.0))))
         .alias("avg_speed_mph"),
        F.when(F.col("fare_amount") > 0,
               round_numeric(F.col("tip_amount") / F.col("fare_amount") * F.lit(100)))
         .alias("tip_percentage"),
    )


def with_storage_partitions(fact: DataFrame) -> DataFrame:
    """Year/month of pickup for the stored fact (a key never moves between
    partitions because pickup_at is part of the key)."""
    return fact.withColumns({"year": F.year("pickup_at").cast("int"),
                             "month": F.month("pickup_at").cast("int")})


def route_unmatched_to_unknown(fact: DataFrame, dim: DataFrame, dim_key: str,
                               fks: Sequence[str], unknown: int = UNKNOWN_ID) -> DataFrame:
    """J-03: foreign keys without a dimension row (and NULLs) become the
    unknown member. A left join on distinct keys never multiplies fact
    rows; AQE broadcasts the keys where their measured size allows."""
    keys = dim.select(F.col(dim_key).alias("_dim_key")).distinct()
    out = fact
    for fk in fks:
        k = keys.withColumnRenamed("_dim_key", f"_dim_key_{fk}")
        dtype = dict(fact.dtypes)[fk]
        out = (out.join(k, out[fk] == k[f"_dim_key_{fk}"], "left")
                  .withColumn(fk, F.coalesce(F.col(f"_dim_key_{fk}").cast(dtype),
                                             F.lit(unknown).cast(dtype)))
                  .drop(f"_dim_key_{fk}"))
    return out.select(*fact.columns)


def with_source_ids(fact: DataFrame, fks: Sequence[str]) -> DataFrame:
    """Each foreign key's own id beside it, as ``<fk>_source``: what a key that is
    routed to the unknown member was, and is again once its member arrives."""
    return fact.withColumns({f"{fk}_source": F.col(fk) for fk in fks})


def reroute(fact: DataFrame, dim: DataFrame, dim_key: str, fks: Sequence[str]) -> DataFrame:
    """The routed keys of a fact that keeps its source ids, against ``dim`` as it
    is now."""
    return route_unmatched_to_unknown(
        fact.withColumns({fk: F.col(f"{fk}_source") for fk in fks}), dim, dim_key, fks)

"""Staging: rename, exact casts, surrogate key, deterministic dedupe, named
cleaning rules (P-01..P-09, W-01).

Plan shape: raw scan (partition-pruned to the window) -> key-determined
rules -> one shuffle on ``trip_id`` for the dedupe (Spark adds a partial
top-1 per key before the shuffle, so a key holding a large share of all
rows is reduced map-side) -> remaining rules -> projection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farebox.functions import duration_minutes, duration_us, half_even_int, ntz_literal, surrogate_key
from farebox.params import PipelineParams

# The columns whose text forms the trip key, in key order.
KEY_COLUMNS = (
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "pulocationid", "dolocationid", "total_amount",
)

# Business names of the staging model, in output order.
STG_COLUMNS = (
    "trip_id", "vendor_id", "pickup_at", "dropoff_at", "pickup_location_id",
    "dropoff_location_id", "payment_type_id", "rate_code_id", "passenger_count",
    "trip_distance_miles", "trip_duration_minutes", "fare_amount", "extra_charges",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "total_amount", "was_store_and_forward",
)

# Dedupe order inside one trip_id: every output column that is not part of
# the key (pickup time is, so it cannot decide), so the surviving row is
# fully determined.
DEDUPE_ORDER = (
    "fare_amount", "tip_amount", "trip_distance_miles",
    "passenger_count", "rate_code_id", "payment_type_id", "was_store_and_forward",
    "extra_charges", "mta_tax", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee",
)

DURATION_US = "_duration_us"


def renamed(raw: DataFrame) -> DataFrame:
    """Surrogate key, business names, exact casts, flag and duration."""
    flag = F.col("store_and_fwd_flag")
    return raw.select(
        surrogate_key(KEY_COLUMNS).alias("trip_id"),
        F.col("vendorid").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_at"),
        F.col("tpep_dropoff_datetime").alias("dropoff_at"),
        F.col("pulocationid").alias("pickup_location_id"),
        F.col("dolocationid").alias("dropoff_location_id"),
        F.col("payment_type").alias("payment_type_id"),
        half_even_int("ratecodeid").alias("rate_code_id"),
        half_even_int("passenger_count").alias("passenger_count"),
        F.col("trip_distance").alias("trip_distance_miles"),
        F.col("fare_amount"),
        F.col("extra").alias("extra_charges"),
        F.col("mta_tax"),
        F.col("tip_amount"),
        F.col("tolls_amount"),
        F.col("improvement_surcharge"),
        F.col("congestion_surcharge"),
        F.col("airport_fee"),
        F.col("total_amount"),
        F.when(flag == "Y", True).when(flag == "N", False).alias("was_store_and_forward"),
        duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("trip_duration_minutes"),
        duration_us("tpep_pickup_datetime", "tpep_dropoff_datetime").alias(DURATION_US),
    )


def cleaning_rules(params: PipelineParams) -> dict[str, Column]:
    """P-06: the named rules a row must pass (all of them). A NULL operand
    makes the rule not TRUE, which rejects the row."""
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    dist = F.col("trip_distance_miles")
    return {
        "forward_in_time": dropoff > pickup,
        "after_window_start": pickup >= ntz_literal(params.start_ts()),
        "before_window_end": pickup < ntz_literal(params.end_ts()),
        "fare_not_negative": F.col("fare_amount") >= 0,
        "total_not_negative": F.col("total_amount") >= 0,
        "distance_positive": dist > 0,
        "distance_below_max": dist < F.lit(params.max_distance_miles),
        "duration_in_bounds": F.col(DURATION_US).between(params.min_duration_us, params.max_duration_us),
    }


# Rules that depend only on columns inside the trip key: every row of one
# trip_id gives the same answer, so they may run before the dedupe.
KEY_DETERMINED_RULES = frozenset({
    "forward_in_time", "after_window_start", "before_window_end",
    "total_not_negative", "duration_in_bounds",
})


def _all(preds) -> Column:
    preds = list(preds)
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def deduplicate(df: DataFrame) -> DataFrame:
    """W-01: keep one row per ``trip_id`` (row_number = 1 over a total order).
    Catalyst plans this as WindowGroupLimit(partial) -> shuffle ->
    WindowGroupLimit(final) -> Window."""
    w = Window.partitionBy("trip_id").orderBy(*[F.col(c).asc_nulls_first() for c in DEDUPE_ORDER])
    return (df.withColumn("_row_num", F.row_number().over(w))
              .where(F.col("_row_num") == 1)
              .drop("_row_num"))


def window_partition_predicate(start: dt.date, end: dt.date) -> Column:
    """(year, month) bounds implied by ``start <= pickup < end`` on a table
    partitioned by the pickup's year and month; becomes PartitionFilters."""
    last = dt.datetime.combine(end, dt.time()) - dt.timedelta(microseconds=1)
    ym = F.col("year") * 100 + F.col("month")
    return ym.between(start.year * 100 + start.month, last.year * 100 + last.month)


def since_partition_predicate(since: Column) -> Column:
    """(year, month) lower bound implied by ``pickup > since``. ``since`` may
    be a scalar subquery: Spark evaluates it before listing files, so only
    partitions at or after the mark are read."""
    ym = F.col("year") * 100 + F.col("month")
    return ym >= F.year(since) * 100 + F.month(since)


def stg_trips(raw: DataFrame, params: PipelineParams, clean: bool = True,
              dedupe: bool = True, since: Column | None = None) -> DataFrame:
    """The staging model. ``raw`` is the aligned raw table (partitioned by
    year/month of pickup when it has those columns).

    ``since`` (optional, e.g. a high-water-mark scalar subquery) keeps only
    trips with ``pickup_at > since``; pickup is part of the key, so this
    runs before the dedupe and prunes raw partitions."""
    src = raw
    partitioned = {"year", "month"} <= set(raw.columns)
    if clean and partitioned:
        src = src.where(window_partition_predicate(params.start, params.end))
    if since is not None and partitioned:
        src = src.where(since_partition_predicate(since))
    r = renamed(src)
    rules = cleaning_rules(params)
    early = [p for n, p in rules.items() if n in KEY_DETERMINED_RULES] if clean else []
    if since is not None:
        early.append(F.col("pickup_at") > since)
    if early:
        r = r.where(_all(early))
    if dedupe:
        r = deduplicate(r)
    if clean:
        r = r.where(_all(p for n, p in rules.items() if n not in KEY_DETERMINED_RULES))
    return r.select(*STG_COLUMNS)

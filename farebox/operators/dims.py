"""Dimensions with unknown members (S-14..S-16, U-01, P-12..P-17, P-21)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import date_key, iso_day_of_week
from farebox.params import DEFAULT_AIRPORT_ZONES
from farebox.sources.seeds import date_spine, date_spine_between, inline_relation

UNKNOWN_ID = -1
UNKNOWN_TEXT = "Unknown"

# Payment type codes of the trip records and their meaning,
# and whether tips are recorded for them (card only).
PAYMENT_TYPES = (
    (0, "Flex Fare", False),
    (1, "Credit card", True),
    (2, "Cash", False),
    (3, "No charge", False),
    (4, "Dispute", False),
    (5, "Unknown", False),
    (6, "Voided trip", False),
)

DIM_LOCATION_COLUMNS = ("location_id", "borough", "zone_name", "service_zone",
                        "zone_full_name", "is_airport")


def dim_location(seed: DataFrame, airport_zones: Sequence[str] = DEFAULT_AIRPORT_ZONES) -> DataFrame:
    """Zone seed -> location dimension, plus the -1 'Unknown' member.

    Seed names are mixed-case (LocationID, Borough, Zone); with
    ``caseSensitive=false`` they resolve without quoting tricks."""
    unknown = F.lit(UNKNOWN_TEXT)
    zone = F.coalesce(F.col("zone"), unknown)
    borough = F.coalesce(F.col("borough"), unknown)
    zones = seed.select(
        F.col("locationid").cast("int").alias("location_id"),
        borough.alias("borough"),
        zone.alias("zone_name"),
        F.coalesce(F.col("service_zone"), unknown).alias("service_zone"),
        F.concat(zone, F.lit(", "), borough).alias("zone_full_name"),
        F.coalesce(F.col("zone"), F.lit("")).isin(list(airport_zones)).alias("is_airport"),
    )
    member = inline_relation(seed.sparkSession,
        [(UNKNOWN_ID, UNKNOWN_TEXT, UNKNOWN_TEXT, UNKNOWN_TEXT, UNKNOWN_TEXT, False)],
        "location_id int, borough string, zone_name string, service_zone string, "
        "zone_full_name string, is_airport boolean")
    return zones.unionByName(member)


def dim_payment_type(spark: SparkSession) -> DataFrame:
    """Literal payment codes plus the -1 member; ``tips_are_reliable`` is an
    aliased copy of ``is_card_payment``."""
    base = inline_relation(spark, list(PAYMENT_TYPES),
                           "payment_type_id int, payment_type_name string, is_card_payment boolean")
    base = base.withColumn("tips_are_reliable", F.col("is_card_payment"))
    member = inline_relation(spark, [(UNKNOWN_ID, UNKNOWN_TEXT, False, False)],
                             "payment_type_id int, payment_type_name string, "
                             "is_card_payment boolean, tips_are_reliable boolean")
    return base.unionByName(member)


def date_attributes(spine: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_day`` spine (ISO day of week and ISO
    week; English month and day names, no padding)."""
    d = F.col("date_day")
    dow = iso_day_of_week(d)
    return spine.select(
        date_key(d).alias("date_key"),
        d.alias("date_day"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
    )


def with_unknown_date(dim: DataFrame) -> DataFrame:
    """U-01: the -1 member of the date dimension: a day that is not known has no
    calendar attributes, an 'Unknown' name and is no weekend."""
    values = {"date_key": UNKNOWN_ID, "month_name": UNKNOWN_TEXT, "day_name": UNKNOWN_TEXT, "is_weekend": False}
    member = inline_relation(dim.sparkSession, [tuple(values.get(f.name) for f in dim.schema.fields)], dim.schema)
    return dim.unionByName(member)


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of ``[start, end)`` and the -1 'Unknown' member."""
    return with_unknown_date(date_attributes(date_spine(spark, start, end)))


def dim_date_covering(df: DataFrame, ts_col: str) -> DataFrame:
    """Date dimension spanning the days of ``ts_col`` found in ``df``: the
    bounds come from one aggregation (partial min/max per task); and the -1
    'Unknown' member."""
    bounds = df.agg(F.min(ts_col).cast("date").alias("start"),
                    F.date_add(F.max(ts_col).cast("date"), 1).alias("end"))
    return with_unknown_date(date_attributes(date_spine_between(bounds)))

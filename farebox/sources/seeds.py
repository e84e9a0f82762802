"""Seeds and generated relations: CSV seed (S-14), inline literal relation
(S-15), daily date spine (S-16)."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

ZONE_SEED_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def read_seed_csv(spark: SparkSession, path: str, schema: str = ZONE_SEED_SCHEMA) -> DataFrame:
    """Header CSV with quoted fields and an explicit schema (no inference).
    The text 'N/A' stays text; an empty field becomes NULL."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").schema(schema).csv(path))


def write_seed_csv(df: DataFrame, path: str) -> None:
    """Write a small reference table as one header CSV with every field
    quoted (seed tables are bounded; one file keeps them reviewable)."""
    (df.coalesce(1).write.mode("overwrite").option("header", True)
       .option("quoteAll", True).csv(path))


def _json_value(v):
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, Decimal):
        raise TypeError("inline_relation: pass decimals as strings or floats")
    return v


def inline_relation(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """S-15: a small literal relation built on the JVM side.

    The rows travel as ONE JSON string literal that ``from_json`` parses
    into an array of structs (constant-folded once), expanded by
    ``inline``: a constant number of driver-to-JVM calls whatever the row
    count. (A ``createDataFrame`` of a Python list becomes a Python RDD,
    which makes every job that reads it start Python workers.)"""
    st = schema if isinstance(schema, T.StructType) else _parse_datatype_string(schema)
    names = st.fieldNames()
    payload = json.dumps([{n: _json_value(v) for n, v in zip(names, row)} for row in rows])
    arr = F.from_json(F.lit(payload), T.ArrayType(st), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    return spark.range(1).select(F.inline(arr)).select(*[F.col(f.name).cast(f.dataType) for f in st.fields])


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """S-16: one row per day in ``[start, end)`` (end exclusive)."""
    return date_spine_between(spark.range(1).select(
        F.lit(start.isoformat()).cast("date").alias("start"),
        F.lit(end.isoformat()).cast("date").alias("end")))


def date_spine_between(bounds: DataFrame) -> DataFrame:
    """Daily spine for a one-row frame of (start date, exclusive end date),
    e.g. bounds derived from the data with an aggregation."""
    start = F.col("start").cast("date")
    last = F.date_sub(F.col("end").cast("date"), 1)
    days = F.when(last >= start, F.sequence(start, last, F.expr("INTERVAL 1 DAY")))
    return bounds.select(F.explode(days).alias("date_day"))

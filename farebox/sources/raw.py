"""Schema-on-write raw trip table (S-08) and schema alignment (S-22)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw trip table of the reference, in its column order.
RAW_COLUMNS: tuple[tuple[str, T.DataType], ...] = (
    ("vendorid", T.IntegerType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("ratecodeid", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pulocationid", T.IntegerType()),
    ("dolocationid", T.IntegerType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
)
RAW_COLUMN_NAMES = tuple(n for n, _ in RAW_COLUMNS)
PICKUP_COL = "tpep_pickup_datetime"
DROPOFF_COL = "tpep_dropoff_datetime"
PARTITION_COLS = ("year", "month")
LOADED_AT = "_loaded_at"

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_COLUMNS])


def align_columns(df: DataFrame, target: Sequence[tuple[str, T.DataType]] = RAW_COLUMNS) -> DataFrame:
    """Lower-case the source names, put them in target order, cast to the
    target types, fill missing columns with typed NULLs and drop extras.

    Works on names case-insensitively per column, so 'Airport_fee' and
    'airport_fee' both land in ``airport_fee``. The result is one
    ``select``: Catalyst prunes the dropped columns out of the scan.
    """
    by_lower: dict[str, str] = {}
    for name in df.columns:
        by_lower.setdefault(name.lower(), name)
    cols: list[Column] = []
    for name, dtype in target:
        src = by_lower.get(name)
        if src is None:
            cols.append(F.lit(None).cast(dtype).alias(name))
        else:
            cols.append(F.col(f"`{src}`").cast(dtype).alias(name))
    return df.select(*cols)


def load_time_literal() -> Column:
    """The load instant (UTC, as timestamp_ntz), taken once on the driver
    so every row of one load carries the same value."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def with_load_timestamp(df: DataFrame) -> DataFrame:
    """Schema-on-write: the aligned columns plus the load time."""
    return df.withColumn(LOADED_AT, load_time_literal())


def same_types(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """``paths`` in groups whose files agree on the type of every column that
    they share, whatever the spelling and whichever are absent. The footers of
    a group are read and merged by one Spark job on the executors; a group
    that does not merge is halved, so k changes of a type in a row of n
    sources cost about k log n jobs, not n."""
    try:
        spark.read.option("mergeSchema", "true").parquet(*paths)
        return [list(paths)]
    except Exception as e:  # the conflict surfaces as a JVM error without a condition of its own
        if len(paths) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(paths) // 2
    return same_types(spark, paths[:half]) + same_types(spark, paths[half:])


def read_aligned(spark: SparkSession, paths: Iterable[str],
                 target: Sequence[tuple[str, T.DataType]] = RAW_COLUMNS) -> DataFrame:
    """Read source files whose schemas drift (casing, missing columns,
    int vs long vs double) as one aligned DataFrame.

    Sources of one folder are tried together, in the order of their names: one
    feed mostly keeps its types, and changes them at a point in time. Each
    group of equal types is read in one scan (merged schema: absent columns
    are NULL), aligned and cast, and the groups are combined by name.
    """
    feeds: dict[str, list[str]] = {}
    for p in paths:
        feeds.setdefault(p.rstrip("/").rsplit("/", 1)[0], []).append(p)
    groups = [g for feed in feeds.values() for g in same_types(spark, sorted(feed))]
    frames = [align_columns(spark.read.option("mergeSchema", "true").parquet(*g), target) for g in groups]
    if not frames:
        from farebox.sources.seeds import inline_relation
        return inline_relation(spark, [], T.StructType([T.StructField(n, t) for n, t in target]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

"""Data-quality checks (C-01..C-06, C-08, C-09, J-02). Each returns a
DataFrame of violations or a one-row verdict; none raises by itself.

All checks are aggregations or anti-joins with partial aggregation per
task, so a key that holds a large share of the rows is combined map-side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import ntz_literal
from farebox.sources.commits import read_log
from farebox.sources.lake import PARTITION_COLS, partition_counts, partition_signatures


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """C-01: keys that occur more than once, with their row count."""
    return (df.groupBy(key).agg(F.count("*").alias("rows"))
              .where(F.col("rows") > 1))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C-02: NULL count per column (one pass), as (column_name, null_rows)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def check_relationships(fact: DataFrame, checks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """C-03 / J-02: for each foreign key ``fk -> (dim, dim_key)``, the fact
    key values without a dimension row and how many fact rows carry them.

    One pass over the fact: the foreign-key columns are unpivoted to
    (column_name, key_value) and counted (partial aggregation), then
    anti-joined once with the union of every dimension's distinct keys
    tagged by column."""
    fks = list(checks)
    keyed = fact.select(*[F.col(fk).cast("bigint").alias(fk) for fk in fks]).unpivot(
        [], fks, "column_name", "key_value")
    # NULL keys are the not-null check's business, not a broken reference
    per_key = (keyed.where(F.col("key_value").isNotNull())
                    .groupBy("column_name", "key_value").agg(F.count("*").alias("rows")))
    dim_keys = None
    for fk, (dim, dim_key) in checks.items():
        k = dim.select(F.lit(fk).alias("column_name"),
                       F.col(dim_key).cast("bigint").alias("key_value")).distinct()
        dim_keys = k if dim_keys is None else dim_keys.unionByName(k)
    missing = per_key.join(dim_keys, ["column_name", "key_value"], "left_anti")
    return missing.select("column_name", "key_value", "rows")


def check_business_rules(trips: DataFrame, max_speed_mph: float = 100.0) -> DataFrame:
    """C-04: trips breaking a business rule -- mean speed above the limit,
    a negative amount, or a dropoff not after the pickup."""
    minutes = F.col("trip_duration_minutes")
    speed = F.when(minutes > 0, F.col("trip_distance_miles") / (minutes / F.lit(60.0)))
    flags = {
        "speed_over_limit": F.coalesce(speed > F.lit(max_speed_mph), F.lit(False)),
        "negative_amount": F.coalesce((F.col("fare_amount") < 0) | (F.col("total_amount") < 0), F.lit(False)),
        "dropoff_not_after_pickup": F.coalesce(F.col("dropoff_at") <= F.col("pickup_at"), F.lit(False)),
    }
    any_bad = flags["speed_over_limit"] | flags["negative_amount"] | flags["dropoff_not_after_pickup"]
    return trips.where(any_bad).select("trip_id", *[v.alias(k) for k, v in flags.items()])


def check_reconciliation(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """C-05: staging rows vs fact rows, difference and verdict. The fact
    count runs as a scalar subquery; both are partial counts per task."""
    fact_rows = fact.agg(F.count("*")).scalar()
    s = staging.agg(F.count("*").alias("staging_rows")).select("staging_rows", fact_rows.alias("fact_rows"))
    diff = F.col("staging_rows") - F.col("fact_rows")
    return s.select("staging_rows", "fact_rows", diff.alias("missing_rows"), (diff == 0).alias("passed"))


def check_freshness(df: DataFrame, ts_col: str, as_of: dt.datetime, max_age: dt.timedelta) -> DataFrame:
    """C-06: age of the newest row at ``as_of`` against a threshold."""
    max_age_s = int(max_age.total_seconds())
    newest = df.agg(F.max(ts_col).alias("newest_at"))
    age = F.timestamp_diff("SECOND", F.col("newest_at"), ntz_literal(as_of))
    return newest.select(
        "newest_at", ntz_literal(as_of).alias("as_of"),
        age.alias("age_seconds"), F.lit(max_age_s).cast("bigint").alias("max_age_seconds"),
        F.coalesce(age <= max_age_s, F.lit(False)).alias("is_fresh"))


def check_audit_drift(audit_latest: DataFrame, lake: DataFrame, table_name: str) -> DataFrame:
    """C-09: partitions whose lake row count differs from the audited one: a
    later file added rows to a loaded month, a loaded month is gone from the
    lake, or a lake month was never loaded (the missing side counts 0)."""
    audited = (audit_latest.where(F.col("table_name") == table_name)
               .select(*PARTITION_COLS, F.col("row_count").alias("audited_rows"),
                       F.lit(0).cast("long").alias("lake_rows")))
    counts = lake.groupBy(*PARTITION_COLS).agg(F.lit(0).cast("long").alias("audited_rows"),
                                               F.count("*").alias("lake_rows"))
    # union and sum instead of an outer join: NULL partition values group too
    return (audited.unionByName(counts).groupBy(*PARTITION_COLS)
            .agg(F.sum("audited_rows").alias("audited_rows"), F.sum("lake_rows").alias("lake_rows"))
            .where(F.col("audited_rows") != F.col("lake_rows")))


def check_signature_drift(spark: SparkSession, lake_root: str, audit_root: str, table_name: str) -> DataFrame:
    """C-09 from the file listing: of every partition the listing's signature is
    compared with the one that its newest load noted; only partitions whose
    files differ are counted, from their footers. A partition that is gone
    from the lake counts 0; one that was never loaded has 0 audited rows;
    files that were rewritten with as many rows are no drift."""
    newest = F.max_by(F.struct("signature", "row_count"), "seq")
    audited = (read_log(spark, audit_root).where((F.col("table_name") == table_name) & (F.col("kind") == "replace"))
               .groupBy(*PARTITION_COLS).agg(newest.alias("n"))
               .select(*PARTITION_COLS, F.col("n.signature").alias("was"), F.lit(None).cast("string").alias("now"),
                       F.col("n.row_count").alias("audited_rows")))
    listed = partition_signatures(spark, lake_root).select(
        *PARTITION_COLS, F.lit(None).cast("string").alias("was"), F.col("signature").alias("now"),
        F.lit(0).cast("long").alias("audited_rows"))
    # union and aggregate instead of an outer join: NULL partition values group too
    both = audited.unionByName(listed).groupBy(*PARTITION_COLS).agg(
        F.max("was").alias("was"), F.max("now").alias("now"), F.sum("audited_rows").alias("audited_rows"))
    changed = both.where(~F.col("was").eqNullSafe(F.col("now"))).select(
        *PARTITION_COLS, "audited_rows", F.lit(0).cast("long").alias("lake_rows"))
    touched = [(r["year"], r["month"]) for r in changed.collect()]   # folder names
    counts = partition_counts(spark, lake_root, touched).select(
        *PARTITION_COLS, F.lit(0).cast("long").alias("audited_rows"), F.col("rows").alias("lake_rows"))
    return (changed.unionByName(counts).groupBy(*PARTITION_COLS)
            .agg(F.sum("audited_rows").alias("audited_rows"), F.sum("lake_rows").alias("lake_rows"))
            .where(F.col("audited_rows") != F.col("lake_rows")))


def check_model_keys(models: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """C-01 and C-02 for every model's key: (model, key, rows, null_keys,
    repeated_keys), one row per model."""
    out = None
    for model, (df, key) in models.items():
        per_key = df.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("n"))
        row = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("repeated_keys"))
        row = row.select(F.lit(model).alias("model"), F.lit(key).alias("key"), "rows", "null_keys", "repeated_keys")
        out = row if out is None else out.unionByName(row)
    return out


def check_load_freshness(audit: DataFrame, as_of: dt.datetime, max_age: dt.timedelta) -> DataFrame:
    """C-06 for the pipeline itself: per table, whether its newest load is at
    most ``max_age`` old at ``as_of``, whatever the data's own times say, and
    the rows of its latest loads."""
    age = F.timestamp_diff("SECOND", F.max("loaded_at"), ntz_literal(as_of))
    return audit.groupBy("table_name").agg(
        (age <= int(max_age.total_seconds())).alias("is_fresh"), F.sum("row_count").alias("audited_rows"))

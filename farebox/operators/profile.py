"""Profiling and star-join reports (A-01..A-14, O-01..O-03).

Star reports aggregate the fact by its foreign key FIRST (partial
aggregation per task, so even a key holding a third of the rows is
combined map-side) and join the few resulting rows to the dimension; the
join then handles one row per key instead of one row per trip. Summing the
per-key counts over the joined rows gives exactly the inner-join count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import exact_mean_2dp, money_2dp, money_sum, round_exact_ratio_2dp


def top_k(df: DataFrame, measure: str, k: int, *tie_break: str) -> DataFrame:
    """O-02: ORDER BY measure DESC LIMIT k, with the keys as tie-break so the
    result is deterministic (planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)


def trips_by_zone(fact: DataFrame, dim_location: DataFrame, fk: str = "pickup_location_id") -> DataFrame:
    """J-01 + A-08: trips per (zone_name, borough). Zone names repeat across
    ids, so the grouping is by name, as in the reference."""
    per_key = fact.groupBy(F.col(fk).alias("location_id")).agg(F.count("*").alias("trips"))
    dim = dim_location.select("location_id", "zone_name", "borough")
    return (per_key.join(dim, "location_id")
                   .groupBy("zone_name", "borough")
                   .agg(F.sum("trips").alias("trips")))


def top_pickup_zones(fact: DataFrame, dim_location: DataFrame, k: int = 5) -> DataFrame:
    """The sample star query: top-k pickup zones by trips."""
    return top_k(trips_by_zone(fact, dim_location), "trips", k, "zone_name", "borough")


def trips_by_month(raw: DataFrame) -> DataFrame:
    """A-01 + O-01: count by (year, month), ordered."""
    return raw.groupBy("year", "month").agg(F.count("*").alias("trips")).orderBy("year", "month")


def busiest_hours(df: DataFrame, ts_col: str, amount_col: str, k: int = 5) -> DataFrame:
    """A-02: trips and mean amount per hour of day, top k by trips.
    The mean is exact: a decimal sum divided by the count, rounded once."""
    agg = (df.groupBy(F.hour(ts_col).cast("int").alias("hour"))
             .agg(F.count("*").alias("trips"),
                  F.sum(F.col(amount_col).cast("decimal(38,6)")).alias("_sum"),
                  F.count(amount_col).alias("_n")))
    out = agg.select("hour", "trips", exact_mean_2dp(F.col("_sum"), F.col("_n"), 6).alias("avg_fare"))
    return top_k(out, "trips", k, "hour")


def top_locations(raw: DataFrame, col: str = "pulocationid", k: int = 5) -> DataFrame:
    """A-03: count by location id, top k."""
    return top_k(raw.groupBy(col).agg(F.count("*").alias("trips")), "trips", k, col)


def quality_counters(raw: DataFrame) -> DataFrame:
    """A-04: six filtered counters in one pass over the raw table."""
    dist, pax = F.col("trip_distance"), F.col("passenger_count")
    return raw.agg(
        F.count_if(F.col("total_amount") < 0).alias("negative_fares"),
        F.count_if(dist <= 0).alias("zero_distance"),
        F.count_if(dist > 200).alias("absurd_distance"),
        F.count_if(pax == 0).alias("zero_passengers"),
        F.count_if(pax.isNull()).alias("null_passengers"),
        F.count_if(F.col("tpep_dropoff_datetime") <= F.col("tpep_pickup_datetime"))
         .alias("dropoff_before_pickup"),
    )


def global_stats(df: DataFrame, dist_col: str = "trip_distance", amount_col: str = "total_amount") -> DataFrame:
    """A-05: count, mean distance, mean amount, max distance, min amount
    (NULL-skipping). Means are exact decimal means rounded to 2 places."""
    agg = df.agg(
        F.count("*").alias("trips"),
        F.sum(F.col(dist_col).cast("decimal(38,6)")).alias("_sd"), F.count(dist_col).alias("_nd"),
        F.sum(F.col(amount_col).cast("decimal(38,6)")).alias("_sa"), F.count(amount_col).alias("_na"),
        F.max(dist_col).alias("max_distance"),
        F.min(amount_col).alias("min_total"),
    )
    return agg.select(
        "trips",
        exact_mean_2dp(F.col("_sd"), F.col("_nd"), 6).alias("mean_distance"),
        exact_mean_2dp(F.col("_sa"), F.col("_na"), 6).alias("mean_total"),
        "max_distance", "min_total")


def rows_kept_summary(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """A-10: rows in, rows kept, rejected, rejected %. Two global counts
    (partial count per task each); the fact count is a scalar subquery."""
    kept = fact.agg(F.count("*")).scalar()
    s = raw.agg(F.count("*").alias("rows_in")).select("rows_in", kept.alias("rows_kept"))
    rejected = F.col("rows_in") - F.col("rows_kept")
    return s.select(
        "rows_in", "rows_kept", rejected.alias("rejected"),
        round_exact_ratio_2dp(rejected.cast("decimal(38,0)"), F.col("rows_in").cast("decimal(38,0)"), 0, 100)
        .alias("rejected_pct"))


def rejects_by_rule(renamed_raw: DataFrame, rules: dict) -> DataFrame:
    """A-11 + P-06: for each named cleaning rule, the rows it rejects (not
    TRUE, so NULL operands count), plus the non-rejecting counter of
    missing passenger counts. One pass."""
    cols = [F.count_if(~F.coalesce(pred, F.lit(False))).alias(f"rejected_{name}")
            for name, pred in rules.items()]
    cols.append(F.count_if(F.col("passenger_count").isNull()).alias("missing_passengers"))
    cols.insert(0, F.count("*").alias("rows_in"))
    return renamed_raw.agg(*cols)


def weekend_revenue_by_quarter(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """A-13 + J-05: revenue by year, quarter and weekend flag: exact sums
    of the amounts, rounded once. The fact is pre-aggregated per date key
    before the join."""
    per_day = fact.groupBy("pickup_date_key").agg(
        F.count("*").alias("trips"), money_sum("total_amount").alias("revenue"))
    dd = dim_date.select("date_key", "year", "quarter", "is_weekend")
    j = per_day.join(dd, per_day.pickup_date_key == dd.date_key)
    return (j.groupBy("year", "quarter", "is_weekend")
             .agg(F.sum("trips").alias("trips"), money_2dp(F.sum("revenue")).alias("revenue"))
             .orderBy("year", "quarter", "is_weekend"))


def tip_rate_reliable(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """A-14 + J-06: tip rate over payment types whose tips are reliable:
    ratio of exact sums, rounded once; the totals are rounded for display."""
    per_type = fact.groupBy("payment_type_id").agg(
        F.count("*").alias("trips"), money_sum("tip_amount").alias("tips"),
        money_sum("fare_amount").alias("fares"))
    dp = dim_payment.where("tips_are_reliable").select("payment_type_id")
    j = per_type.join(dp, "payment_type_id", "left_semi")
    s = j.agg(F.sum("trips").alias("trips"), F.sum("tips").cast("decimal(38,6)").alias("tips"),
              F.sum("fares").cast("decimal(38,6)").alias("fares"))
    return s.select("trips", money_2dp(F.col("tips")).alias("tip_total"),
                    money_2dp(F.col("fares")).alias("fare_total"),
                    round_exact_ratio_2dp(F.col("tips"), F.col("fares"), 6, 100).alias("tip_rate_pct"))


def payment_type_usage(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Payment dimension with its trip counts (every member, 0 if unused).

    The aggregated side's shuffle output is measured by AQE, which turns the
    join into a broadcast at run time (a few rows per code)."""
    per_type = fact.groupBy("payment_type_id").agg(F.count("*").alias("trips"))
    dp = dim_payment.withColumn("payment_type_id", F.col("payment_type_id").cast("bigint"))
    return (dp.join(per_type, "payment_type_id", "left")
              .select("payment_type_id", "payment_type_name", "is_card_payment",
                      "tips_are_reliable", F.coalesce(F.col("trips"), F.lit(0)).alias("trips")))

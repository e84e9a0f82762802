"""DuckDB SQL twins of the named queries (independent re-statements in
plain SQL over the pre-registered driver tables).

No constant comes from the engine: a wrong one there cannot agree here.
"""

from __future__ import annotations

# Fixed values, stated apart from the engine's own: the fixture's window, its
# bounds and airports, the arrival cut-off, and the queries' parameters.
START, END = "1996-01-01", "2001-01-01"
CUTOFF = "1998-06-01 00:00:00"
MIN_US = 60 * 1000000
MAX_US = 1440 * 365 * 60 * 1000000
MAX_DIST = 200.0
AIRPORTS = "'NATION_1', 'NATION_13'"
EV_Y1, EV_M1, EV_Y2, EV_M2 = 2024, 1, 2024, 2
ONE_MONTH = (1996, 1)
FRESH_AS_OF, FRESH_SECONDS = "2024-02-01 00:00:00", 24 * 3600


def rn(x: str) -> str:
    """round(x::numeric, 2) with the 15-significant-digit rule."""
    return f"CAST(ROUND(CAST(printf('%.15g', {x}) AS DECIMAL(38,15)), 2) AS DECIMAL(18,2))"


def cents_to_dec(q: str) -> str:
    return f"CAST(CAST({q} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def half_up_div(num: str, den: str) -> str:
    """round(num/den) half away from zero for HUGEINT num, den > 0."""
    return (f"(CASE WHEN ({den}) > 0 THEN sign({num}) * ((abs({num}) * 2 + ({den})) // (({den}) * 2)) END)")


def mean_2dp(sum6: str, n: str) -> str:
    """exact HALF_UP mean to 2 decimals from a DECIMAL(38,6) sum."""
    num = f"(CAST(({sum6}) * 1000000 AS HUGEINT) * 100)"
    den = f"(CAST({n} AS HUGEINT) * 1000000)"
    return cents_to_dec(half_up_div(num, den))


def ratio_2dp(num_dec: str, den_dec: str, scale: int, factor: int) -> str:
    num = f"(CAST(({num_dec}) * {10 ** scale} AS HUGEINT) * {100 * factor})"
    den = f"CAST(({den_dec}) * {10 ** scale} AS HUGEINT)"
    return cents_to_dec(half_up_div(num, den))


KEY_TEXT = " || '|' || ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in
    ("vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "dolocationid", "total_amount"))

RAW_CTE = f"""
b AS (
  SELECT l_linenumber AS vendorid,
         CASE WHEN l_partkey % 250 <> 9 THEN o_orderdate END AS tpep_pickup_datetime,
         CASE WHEN l_partkey % 200 <> 3 THEN l_shipdate END AS tpep_dropoff_datetime,
         CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_quantity / 2 END AS passenger_count,
         (l_quantity - 1) * 5 AS trip_distance,
         CAST(l_partkey % 12 AS DOUBLE) / 2 AS ratecodeid,
         CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'N' THEN 'N' END AS store_and_fwd_flag,
         CASE WHEN l_partkey % 90 = 7 THEN 264 ELSE c_nationkey END AS pulocationid,
         CASE WHEN l_partkey % 90 = 11 THEN 265 ELSE NULLIF(s_nationkey, 24) END AS dolocationid,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE CAST(substring(o_orderpriority, 1, 1) AS BIGINT) END AS payment_type,
         l_extendedprice - 2000 AS fare_amount,
         l_extendedprice * l_discount AS tip_amount,
         (l_extendedprice - 2000) * (1 + l_tax) + l_extendedprice * l_discount AS total_amount,
         l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey
                JOIN supplier ON l_suppkey = s_suppkey
),
u AS (
  SELECT * FROM b
  UNION ALL SELECT * FROM b WHERE l_partkey % 50 = 0
  UNION ALL SELECT vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
                   trip_distance, ratecodeid, store_and_fwd_flag, pulocationid, dolocationid,
                   payment_type, fare_amount, tip_amount + 1, total_amount, l_partkey
            FROM b WHERE l_partkey % 75 = 0
),
raw AS (
  SELECT vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         ratecodeid, store_and_fwd_flag, pulocationid, dolocationid, payment_type, fare_amount,
         CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, tip_amount,
         CAST(0.0 AS DOUBLE) AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         total_amount, CAST(2.5 AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
  FROM u
)"""

# Names and predicates of the model.
RENAMED_CTE = f"""
renamed AS (
  SELECT md5({KEY_TEXT}) AS trip_id,
         vendorid AS vendor_id,
         tpep_pickup_datetime AS pickup_at,
         tpep_dropoff_datetime AS dropoff_at,
         pulocationid AS pickup_location_id,
         dolocationid AS dropoff_location_id,
         payment_type AS payment_type_id,
         CAST(ratecodeid AS INTEGER) AS rate_code_id,
         CAST(passenger_count AS INTEGER) AS passenger_count,
         trip_distance AS trip_distance_miles,
         fare_amount, extra AS extra_charges, mta_tax, tip_amount, tolls_amount,
         improvement_surcharge, congestion_surcharge, airport_fee, total_amount,
         CASE WHEN store_and_fwd_flag = 'Y' THEN true WHEN store_and_fwd_flag = 'N' THEN false END
           AS was_store_and_forward,
         date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(60000000 AS DOUBLE)
           AS trip_duration_minutes,
         date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) AS duration_us
  FROM raw
)"""

DEDUP_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in (
    "fare_amount", "tip_amount", "trip_distance_miles", "passenger_count",
    "rate_code_id", "payment_type_id", "was_store_and_forward", "extra_charges", "mta_tax",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee"))

DEDUP_CTE = f"""
dedup AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY {DEDUP_ORDER}) AS _rn FROM renamed
  ) WHERE _rn = 1
)"""

STG_COLS = ("trip_id, vendor_id, pickup_at, dropoff_at, pickup_location_id, dropoff_location_id, "
            "payment_type_id, rate_code_id, passenger_count, trip_distance_miles, trip_duration_minutes, "
            "fare_amount, extra_charges, mta_tax, tip_amount, tolls_amount, improvement_surcharge, "
            "congestion_surcharge, airport_fee, total_amount, was_store_and_forward")

# Names and predicates of the model.
RULES = {
    "forward_in_time": "dropoff_at > pickup_at",
    "after_window_start": f"pickup_at >= TIMESTAMP '{START}'",
    "before_window_end": f"pickup_at < TIMESTAMP '{END}'",
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "distance_positive": "trip_distance_miles > 0",
    "distance_below_max": f"trip_distance_miles < {MAX_DIST}",
    "duration_in_bounds": f"duration_us BETWEEN {MIN_US} AND {MAX_US}",
}

STG_CTE = f"""
stg AS (
  SELECT {STG_COLS} FROM dedup
  WHERE {' AND '.join(RULES.values())}
)"""

MINUTES_2DP = cents_to_dec(
    "sign(date_diff('microsecond', pickup_at, dropoff_at)) * "
    "((abs(date_diff('microsecond', pickup_at, dropoff_at)) * 2 + 600000) // 1200000)")

# Names and predicates of the model.
FCT_SELECT = f"""
  SELECT trip_id,
         CAST(strftime(pickup_at, '%Y%m%d') AS INTEGER) AS pickup_date_key,
         coalesce(pickup_location_id, -1) AS pickup_location_id,
         coalesce(dropoff_location_id, -1) AS dropoff_location_id,
         coalesce(payment_type_id, -1) AS payment_type_id,
         vendor_id, pickup_at, dropoff_at, passenger_count, trip_distance_miles,
         {MINUTES_2DP} AS trip_duration_minutes,
         fare_amount, extra_charges, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         congestion_surcharge, airport_fee, total_amount,
         CASE WHEN trip_duration_minutes > 0
              THEN {rn('trip_distance_miles / (trip_duration_minutes / 60.0)')} END AS avg_speed_mph,
         CASE WHEN fare_amount > 0 THEN {rn('tip_amount / fare_amount * 100')} END AS tip_percentage"""

FCT_CTE = f"""
fct AS ({FCT_SELECT}
  FROM stg
)"""

ZONES_CTE = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
         CASE WHEN n_regionkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

DIM_LOCATION_CTE = f"""
dim_location AS (
  SELECT location_id,
         coalesce(borough, 'Unknown') AS borough,
         coalesce(zone, 'Unknown') AS zone_name,
         coalesce(service_zone, 'Unknown') AS service_zone,
         coalesce(zone, 'Unknown') || ', ' || coalesce(borough, 'Unknown') AS zone_full_name,
         coalesce(zone, '') IN ({AIRPORTS}) AS is_airport
  FROM zones
  UNION ALL
  SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', false
)"""

# The payment dimension's literal rows.
DIM_PAYMENT_CTE = """
dim_payment AS (
  SELECT payment_type_id, payment_type_name, is_card_payment, is_card_payment AS tips_are_reliable
  FROM (VALUES (0, 'Flex Fare', false), (1, 'Credit card', true), (2, 'Cash', false),
               (3, 'No charge', false), (4, 'Dispute', false), (5, 'Unknown', false),
               (6, 'Voided trip', false)) AS t(payment_type_id, payment_type_name, is_card_payment)
  UNION ALL SELECT -1, 'Unknown', false, false
)"""


def dim_date_select(spine: str) -> str:
    return f"""
  SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key,
         date_day,
         CAST(year(date_day) AS INTEGER) AS year,
         CAST(quarter(date_day) AS INTEGER) AS quarter,
         CAST(month(date_day) AS INTEGER) AS month,
         strftime(date_day, '%B') AS month_name,
         CAST(day(date_day) AS INTEGER) AS day_of_month,
         CAST(isodow(date_day) AS INTEGER) AS day_of_week,
         strftime(date_day, '%A') AS day_name,
         isodow(date_day) IN (6, 7) AS is_weekend,
         CAST(weekofyear(date_day) AS INTEGER) AS week_of_year
  FROM {spine}
  UNION ALL
  SELECT -1, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, 'Unknown', false, NULL"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


STG_CHAIN = (RAW_CTE, RENAMED_CTE, DEDUP_CTE, STG_CTE)
FCT_CHAIN = STG_CHAIN + (FCT_CTE,)
ARRIVED_CUT = f"dropoff_at < TIMESTAMP '{CUTOFF}'"
FACT_COLS = ("trip_id, pickup_date_key, pickup_location_id, dropoff_location_id, payment_type_id, "
             "vendor_id, pickup_at, dropoff_at, passenger_count, trip_distance_miles, "
             "trip_duration_minutes, fare_amount, extra_charges, mta_tax, tip_amount, tolls_amount, "
             "improvement_surcharge, congestion_surcharge, airport_fee, total_amount, avg_speed_mph, "
             "tip_percentage")
RAW_COLS = ("vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
            "ratecodeid, store_and_fwd_flag, pulocationid, dolocationid, payment_type, fare_amount, "
            "extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, "
            "congestion_surcharge, airport_fee, year, month")

# lake v1 holds the trips that arrived before the cut-off (dropoff time)
RAW_ARRIVED = f"raw_arrived AS (SELECT * FROM raw WHERE tpep_dropoff_datetime < TIMESTAMP '{CUTOFF}')"
V1_COUNTS = "v1 AS (SELECT year, month, count(*) AS n FROM raw_arrived GROUP BY year, month)"
V2_COUNTS = "v2 AS (SELECT year, month, count(*) AS n FROM raw GROUP BY year, month)"

SQL: dict[str, str] = {}

SQL["top_pickup_zones"] = with_(*FCT_CHAIN, ZONES_CTE, DIM_LOCATION_CTE) + """
SELECT l.zone_name, l.borough, count(*) AS trips
FROM fct f JOIN dim_location l ON f.pickup_location_id = l.location_id
GROUP BY 1, 2
ORDER BY trips DESC, zone_name, borough
LIMIT 5"""

SQL["scan_pruned_columns"] = """
SELECT count(*) AS rows,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_extendedprice
FROM lineitem"""

SQL["lake_roundtrip_counts"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS trips FROM raw GROUP BY year, month ORDER BY year, month"""

SQL["lake_one_month"] = with_(RAW_CTE) + f"""
SELECT trip_distance, total_amount FROM raw WHERE year = {ONE_MONTH[0]} AND month = {ONE_MONTH[1]}"""

SQL["lake_partitions"] = with_(RAW_CTE) + """
SELECT DISTINCT year, month FROM raw ORDER BY year, month"""

SQL["source_file_counts"] = f"""
WITH files AS (
  SELECT {EV_Y1} AS year, {EV_M1} AS month, 'events.parquet' AS file_name,
         (SELECT count(*) FROM events) AS rows
  UNION ALL
  SELECT {EV_Y2}, {EV_M2}, 'events_{EV_Y2:04d}-{EV_M2:02d}.parquet', CAST(NULL AS BIGINT)
)
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, file_name, rows,
       rows IS NULL AS is_missing, CAST(sum(rows) OVER () AS BIGINT) AS total_rows
FROM files"""

SQL["stray_dates"] = f"""
WITH c AS (
  SELECT count(*) AS rows,
         count(*) FILTER (WHERE year(ts) = {EV_Y1} AND month(ts) = {EV_M1}) AS in_month
  FROM events
)
SELECT CAST({EV_Y1} AS INTEGER) AS year, CAST({EV_M1} AS INTEGER) AS month,
       'events.parquet' AS file_name, rows, in_month, rows - in_month AS stray,
       {ratio_2dp('CAST(rows - in_month AS DECIMAL(38,0))', 'CAST(rows AS DECIMAL(38,0))', 0, 100)} AS stray_pct
FROM c"""

SQL["stray_dates_trips"] = with_(RAW_CTE) + f"""
, c AS (
  SELECT CAST(year(tpep_dropoff_datetime) AS INTEGER) AS year,
         CAST(month(tpep_dropoff_datetime) AS INTEGER) AS month,
         'file_month=' || coalesce(strftime(tpep_dropoff_datetime, '%Y-%m'), '__HIVE_DEFAULT_PARTITION__')
           AS file_name,
         count(*) AS rows,
         count(*) FILTER (WHERE year(tpep_pickup_datetime) = year(tpep_dropoff_datetime)
                            AND month(tpep_pickup_datetime) = month(tpep_dropoff_datetime)) AS in_month
  FROM raw GROUP BY 1, 2, 3
)
SELECT year, month, file_name, rows, in_month, rows - in_month AS stray,
       {ratio_2dp('CAST(rows - in_month AS DECIMAL(38,0))', 'CAST(rows AS DECIMAL(38,0))', 0, 100)} AS stray_pct
FROM c"""

SQL["aligned_raw"] = with_(RAW_CTE) + f"\nSELECT {RAW_COLS} FROM raw"

SQL["partition_replace"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS trips FROM raw GROUP BY year, month ORDER BY year, month"""

SQL["audit_latest"] = with_(RAW_CTE) + """
SELECT 'yellow_trips' AS table_name, year, month, count(*) AS row_count FROM raw GROUP BY year, month"""

SQL["incremental_load"] = with_(RAW_CTE, RAW_ARRIVED, V1_COUNTS, V2_COUNTS) + """
SELECT v2.year, v2.month, coalesce(v1.n, v2.n) AS trips
FROM v2 LEFT JOIN v1 ON v1.year IS NOT DISTINCT FROM v2.year AND v1.month IS NOT DISTINCT FROM v2.month
ORDER BY v2.year, v2.month"""

SQL["check_audit_drift"] = with_(RAW_CTE, RAW_ARRIVED, V1_COUNTS, V2_COUNTS) + f"""
SELECT v2.year, v2.month, coalesce(v1.n, v2.n) AS audited_rows,
       CASE WHEN v2.year = {ONE_MONTH[0]} AND v2.month = {ONE_MONTH[1]} THEN 0 ELSE v2.n END AS lake_rows
FROM v2 LEFT JOIN v1 ON v1.year IS NOT DISTINCT FROM v2.year AND v1.month IS NOT DISTINCT FROM v2.month
WHERE coalesce(v1.n, v2.n) <> v2.n OR (v2.year = {ONE_MONTH[0]} AND v2.month = {ONE_MONTH[1]})"""

SQL["lake_layout"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS rows, true AS has_files, true AS has_bytes FROM raw GROUP BY year, month"""

SQL["dataset_summary"] = with_(RAW_CTE) + """
SELECT count(*) AS rows, 21 AS columns, (SELECT count(*) FROM (SELECT DISTINCT year, month FROM raw)) AS partitions
FROM raw"""

SQL["lake_from_monthly_files"] = with_(RAW_CTE) + f"""
SELECT year, month, count(*) AS trips, 1 AS absent_sources FROM raw
WHERE tpep_dropoff_datetime IS NOT NULL GROUP BY year, month"""

SQL["lake_append_month"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS trips FROM raw GROUP BY year, month"""

SQL["schema_change_gate"] = with_(*FCT_CHAIN) + f"""
SELECT CAST(year(pickup_at) AS INTEGER) AS year, CAST(month(pickup_at) AS INTEGER) AS month,
       count(*) AS trips, true AS refused
FROM fct
WHERE {ARRIVED_CUT}
   OR pickup_at > (SELECT coalesce(max(pickup_at), TIMESTAMP '1900-01-01') FROM fct WHERE {ARRIVED_CUT})
GROUP BY 1, 2"""

SQL["check_model_keys"] = with_(*FCT_CHAIN, ZONES_CTE, DIM_LOCATION_CTE, DIM_PAYMENT_CTE) + f"""
, spine AS (SELECT CAST(d AS DATE) AS date_day FROM (
    SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d
    FROM orders)),
dim_date AS ({dim_date_select('spine')}),
keys AS (
  SELECT 'raw' AS model, 'trip_id' AS key, CAST(trip_id AS VARCHAR) AS k FROM renamed
  UNION ALL SELECT 'fct_trips', 'trip_id', CAST(trip_id AS VARCHAR) FROM fct
  UNION ALL SELECT 'dim_location', 'location_id', CAST(location_id AS VARCHAR) FROM dim_location
  UNION ALL SELECT 'dim_payment_type', 'payment_type_id', CAST(payment_type_id AS VARCHAR) FROM dim_payment
  UNION ALL SELECT 'dim_date', 'date_key', CAST(date_key AS VARCHAR) FROM dim_date),
n AS (SELECT model, key, k, count(*) AS n FROM keys GROUP BY ALL)
SELECT model, key, CAST(sum(n) AS BIGINT) AS rows,
       CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS repeated_keys
FROM n GROUP BY model, key"""

SQL["check_load_freshness"] = with_(RAW_CTE) + """
SELECT 'yellow_trips' AS table_name, seen = 'now' AS is_fresh, (SELECT count(*) FROM raw) AS audited_rows, seen
FROM (VALUES ('now'), ('two days on')) AS t(seen)"""

SQL["stored_star_report"] = SQL["top_pickup_zones"]

SQL["stg_trips"] = with_(*STG_CHAIN) + "\nSELECT * FROM stg"

SQL["stg_dedup"] = with_(RAW_CTE, RENAMED_CTE, DEDUP_CTE) + f"\nSELECT {STG_COLS} FROM dedup"

SQL["stg_types"] = with_(RAW_CTE, RENAMED_CTE) + """
SELECT trip_id, rate_code_id, passenger_count, was_store_and_forward, trip_duration_minutes FROM renamed"""

SQL["fct_trips"] = with_(*FCT_CHAIN) + "\nSELECT * FROM fct"

SQL["fct_incremental"] = with_(*FCT_CHAIN) + f"""
SELECT {FACT_COLS} FROM fct
WHERE {ARRIVED_CUT}
   OR pickup_at > (SELECT coalesce(max(pickup_at), TIMESTAMP '1900-01-01') FROM fct WHERE {ARRIVED_CUT})"""

SQL["fct_incremental_upsert"] = with_(*FCT_CHAIN) + f"\nSELECT {FACT_COLS} FROM fct"

SQL["fct_unmatched_to_unknown"] = with_(*FCT_CHAIN, ZONES_CTE, DIM_LOCATION_CTE) + f"""
, keys AS (SELECT DISTINCT location_id FROM dim_location)
SELECT f.trip_id,
       coalesce(p.location_id, -1) AS pickup_location_id,
       coalesce(d.location_id, -1) AS dropoff_location_id
FROM fct f
LEFT JOIN keys p ON f.pickup_location_id = p.location_id
LEFT JOIN keys d ON f.dropoff_location_id = d.location_id"""

SQL["dim_date"] = ("WITH spine AS (SELECT CAST(d AS DATE) AS date_day FROM ("
                   "SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), "
                   "INTERVAL 1 DAY)) AS d FROM orders))" + dim_date_select("spine"))

SQL["dim_location"] = with_(ZONES_CTE, DIM_LOCATION_CTE) + "\nSELECT * FROM dim_location"

SQL["payment_type_usage"] = with_(*FCT_CHAIN, DIM_PAYMENT_CTE) + """
, per_type AS (SELECT payment_type_id, count(*) AS trips FROM fct GROUP BY payment_type_id)
SELECT CAST(d.payment_type_id AS BIGINT) AS payment_type_id, d.payment_type_name, d.is_card_payment,
       d.tips_are_reliable, coalesce(p.trips, 0) AS trips
FROM dim_payment d LEFT JOIN per_type p ON CAST(d.payment_type_id AS BIGINT) = p.payment_type_id"""

SQL["seed_csv_roundtrip"] = SQL["dim_location"]

SQL["trips_by_month"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS trips FROM raw GROUP BY year, month ORDER BY year, month"""

SQL["busiest_hours"] = f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips,
       {mean_2dp('sum(CAST(value AS DECIMAL(38,6)))', 'count(value)')} AS avg_fare
FROM events GROUP BY 1
ORDER BY trips DESC, hour
LIMIT 5"""

SQL["top_pickup_locations"] = with_(RAW_CTE) + """
SELECT pulocationid, count(*) AS trips FROM raw GROUP BY 1 ORDER BY trips DESC, pulocationid LIMIT 5"""

# Names and predicates of the model.
SQL["quality_counters"] = with_(RAW_CTE) + """
SELECT count(*) FILTER (WHERE total_amount < 0) AS negative_fares,
       count(*) FILTER (WHERE trip_distance <= 0) AS zero_distance,
       count(*) FILTER (WHERE trip_distance > 200) AS absurd_distance,
       count(*) FILTER (WHERE passenger_count = 0) AS zero_passengers,
       count(*) FILTER (WHERE passenger_count IS NULL) AS null_passengers,
       count(*) FILTER (WHERE tpep_dropoff_datetime <= tpep_pickup_datetime) AS dropoff_before_pickup
FROM raw"""

SQL["global_stats"] = with_(RAW_CTE) + f"""
SELECT count(*) AS trips,
       {mean_2dp('sum(CAST(trip_distance AS DECIMAL(38,6)))', 'count(trip_distance)')} AS mean_distance,
       {mean_2dp('sum(CAST(total_amount AS DECIMAL(38,6)))', 'count(total_amount)')} AS mean_total,
       max(trip_distance) AS max_distance,
       min(total_amount) AS min_total
FROM raw"""

SQL["rows_kept_summary"] = with_(*FCT_CHAIN) + f"""
, c AS (SELECT (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM fct) AS rows_kept)
SELECT rows_in, rows_kept, rows_in - rows_kept AS rejected,
       {ratio_2dp('CAST(rows_in - rows_kept AS DECIMAL(38,0))', 'CAST(rows_in AS DECIMAL(38,0))', 0, 100)}
         AS rejected_pct
FROM c"""

SQL["rejects_by_rule"] = with_(RAW_CTE, RENAMED_CTE) + "\nSELECT count(*) AS rows_in, " + ", ".join(
    f"count(*) FILTER (WHERE NOT coalesce({pred}, false)) AS rejected_{name}" for name, pred in RULES.items()
) + ", count(*) FILTER (WHERE passenger_count IS NULL) AS missing_passengers FROM renamed"

SQL["weekend_revenue_by_quarter"] = with_(*FCT_CHAIN) + f"""
, spine AS (SELECT CAST(d AS DATE) AS date_day
            FROM (SELECT unnest(generate_series(DATE '{START}', DATE '{END}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)),
dim_date AS ({dim_date_select('spine')})
SELECT dd.year, dd.quarter, dd.is_weekend, count(*) AS trips,
       CAST(round(sum(CAST(f.total_amount AS DECIMAL(38,6))), 2) AS DECIMAL(38,2)) AS revenue
FROM fct f JOIN dim_date dd ON f.pickup_date_key = dd.date_key
GROUP BY 1, 2, 3
ORDER BY 1, 2, 3"""

SQL["tip_rate_reliable"] = with_(*FCT_CHAIN, DIM_PAYMENT_CTE) + f"""
, s AS (
  SELECT count(*) AS trips,
         CAST(sum(CAST(tip_amount AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS tips,
         CAST(sum(CAST(fare_amount AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS fares
  FROM fct WHERE payment_type_id IN (SELECT payment_type_id FROM dim_payment WHERE tips_are_reliable)
)
SELECT trips, CAST(round(tips, 2) AS DECIMAL(38,2)) AS tip_total, CAST(round(fares, 2) AS DECIMAL(38,2)) AS fare_total,
       {ratio_2dp('tips', 'fares', 6, 100)} AS tip_rate_pct FROM s"""

SQL["check_unique"] = with_(RAW_CTE, RENAMED_CTE) + """
SELECT trip_id, count(*) AS rows FROM renamed GROUP BY trip_id HAVING count(*) > 1"""

SQL["check_not_null"] = with_(RAW_CTE, RENAMED_CTE) + """
, c AS (SELECT count(*) FILTER (WHERE trip_id IS NULL) AS trip_id,
               count(*) FILTER (WHERE pickup_location_id IS NULL) AS pickup_location_id,
               count(*) FILTER (WHERE dropoff_location_id IS NULL) AS dropoff_location_id,
               count(*) FILTER (WHERE payment_type_id IS NULL) AS payment_type_id,
               count(*) FILTER (WHERE passenger_count IS NULL) AS passenger_count
        FROM renamed)
SELECT column_name, null_rows FROM c
UNPIVOT (null_rows FOR column_name IN (trip_id, pickup_location_id, dropoff_location_id,
                                       payment_type_id, passenger_count))"""

SQL["check_relationships"] = with_(*FCT_CHAIN, ZONES_CTE, DIM_LOCATION_CTE, DIM_PAYMENT_CTE) + f"""
, loc AS (SELECT DISTINCT CAST(location_id AS BIGINT) AS k FROM dim_location),
pay AS (SELECT DISTINCT CAST(payment_type_id AS BIGINT) AS k FROM dim_payment)
SELECT 'pickup_location_id' AS column_name, CAST(pickup_location_id AS BIGINT) AS key_value, count(*) AS rows
FROM fct WHERE pickup_location_id IS NOT NULL AND CAST(pickup_location_id AS BIGINT) NOT IN (SELECT k FROM loc) GROUP BY 2
UNION ALL
SELECT 'dropoff_location_id', CAST(dropoff_location_id AS BIGINT), count(*)
FROM fct WHERE dropoff_location_id IS NOT NULL AND CAST(dropoff_location_id AS BIGINT) NOT IN (SELECT k FROM loc) GROUP BY 2
UNION ALL
SELECT 'payment_type_id', CAST(payment_type_id AS BIGINT), count(*)
FROM fct WHERE payment_type_id IS NOT NULL AND CAST(payment_type_id AS BIGINT) NOT IN (SELECT k FROM pay) GROUP BY 2
UNION ALL
SELECT 'pickup_date_key', CAST(pickup_date_key AS BIGINT), count(*)
FROM fct WHERE strptime(CAST(pickup_date_key AS VARCHAR), '%Y%m%d') NOT BETWEEN DATE '{START}' AND DATE '{END}' - 1
GROUP BY 2"""

SQL["check_business_rules"] = with_(RAW_CTE, RENAMED_CTE, DEDUP_CTE) + """
, flags AS (
  SELECT trip_id,
         coalesce(CASE WHEN trip_duration_minutes > 0
                       THEN trip_distance_miles / (trip_duration_minutes / 60.0) END > 100.0, false)
           AS speed_over_limit,
         coalesce(fare_amount < 0 OR total_amount < 0, false) AS negative_amount,
         coalesce(dropoff_at <= pickup_at, false) AS dropoff_not_after_pickup
  FROM dedup)
SELECT * FROM flags WHERE speed_over_limit OR negative_amount OR dropoff_not_after_pickup"""

SQL["check_reconciliation"] = with_(*FCT_CHAIN) + f"""
, kept AS (SELECT * FROM fct
           WHERE {ARRIVED_CUT}
              OR pickup_at > (SELECT coalesce(max(pickup_at), TIMESTAMP '1900-01-01') FROM fct WHERE {ARRIVED_CUT})),
c AS (SELECT (SELECT count(*) FROM stg) AS staging_rows, (SELECT count(*) FROM kept) AS fact_rows)
SELECT staging_rows, fact_rows, staging_rows - fact_rows AS missing_rows,
       staging_rows = fact_rows AS passed
FROM c"""

SQL["check_freshness"] = f"""
WITH n AS (SELECT max(ts) AS newest_at FROM events)
SELECT newest_at, TIMESTAMP '{FRESH_AS_OF}' AS as_of,
       date_sub('second', newest_at, TIMESTAMP '{FRESH_AS_OF}') AS age_seconds,
       CAST({FRESH_SECONDS} AS BIGINT) AS max_age_seconds,
       coalesce(date_sub('second', newest_at, TIMESTAMP '{FRESH_AS_OF}')
                <= {FRESH_SECONDS}, false) AS is_fresh
FROM n"""

BY_MONTH = with_(RAW_CTE) + """
SELECT year, month, count(*) AS trips FROM raw GROUP BY year, month"""

SQL["incremental_reload_changed"] = BY_MONTH

SQL["trips_by_month_kept"] = BY_MONTH

SQL["lake_append_twice"] = BY_MONTH

SQL["lake_compacted"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS trips, true AS packed FROM raw GROUP BY year, month"""

SQL["lake_daily"] = with_(RAW_CTE) + """
SELECT year, month, CAST(day(tpep_pickup_datetime) AS INTEGER) AS day, count(*) AS trips FROM raw GROUP BY ALL"""

SQL["lake_clustered_zone"] = with_(RAW_CTE) + f"""
SELECT trip_distance, total_amount FROM raw
WHERE year = {ONE_MONTH[0]} AND month = {ONE_MONTH[1]} AND pulocationid = 7"""

SQL["check_signature_drift"] = SQL["check_audit_drift"]

SQL["profile_from_summaries"] = (
    "WITH c AS (" + SQL["quality_counters"] + "), s AS (" + SQL["global_stats"] + ")\nSELECT * FROM c, s")

SQL["fct_incremental_mixed"] = with_(*FCT_CHAIN) + f"""
, first_two AS (
  SELECT * FROM fct
  WHERE {ARRIVED_CUT} OR strftime(pickup_at, '%Y-%m') IN ('1996-01', '1999-03'))
SELECT {FACT_COLS} FROM first_two
UNION ALL
SELECT {FACT_COLS} FROM fct WHERE pickup_at > (SELECT max(pickup_at) FROM first_two)"""

SQL["fct_rerouted"] = with_(*FCT_CHAIN, ZONES_CTE, DIM_LOCATION_CTE) + """
, keys AS (SELECT DISTINCT location_id FROM dim_location UNION SELECT 264)
SELECT f.trip_id,
       coalesce(p.location_id, -1) AS pickup_location_id,
       coalesce(d.location_id, -1) AS dropoff_location_id
FROM fct f
LEFT JOIN keys p ON f.pickup_location_id = p.location_id
LEFT JOIN keys d ON f.dropoff_location_id = d.location_id"""

SQL["lake_row_counts"] = with_(RAW_CTE) + """
SELECT year, month, count(*) AS rows FROM raw GROUP BY year, month"""

# Columns of the raw table and their types.
STRUCTURE = {"vendorid": "int", "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
             "passenger_count": "double", "trip_distance": "double", "ratecodeid": "double", "store_and_fwd_flag": "string",
             "pulocationid": "int", "dolocationid": "int", "payment_type": "bigint", "fare_amount": "double", "extra": "double",
             "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double", "improvement_surcharge": "double",
             "total_amount": "double", "congestion_surcharge": "double", "airport_fee": "double"}

SQL["dataset_structure"] = with_(RAW_CTE) + " UNION ALL ".join(
    f"""
SELECT year, month, '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, count(*) - count({c}) AS nulls,
       {f'CAST(min({c}) AS DOUBLE)' if t in ('int', 'bigint', 'double') else 'CAST(NULL AS DOUBLE)'} AS min_value,
       {f'CAST(max({c}) AS DOUBLE)' if t in ('int', 'bigint', 'double') else 'CAST(NULL AS DOUBLE)'} AS max_value
FROM raw GROUP BY year, month""" for c, t in STRUCTURE.items())

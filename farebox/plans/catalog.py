"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Every query reads the given parquet tables (through the adapters of
``farebox.sources.fixtures``) so that its work grows with them. Queries
that need stored tables (lake, raw table, audit log, incremental fact)
build them once per session and source directory below the shared
checkpoint root, and read them back.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import ntz_literal
from farebox.operators import checks, dims, profile, staging, summaries
from farebox.operators.fact import FACT_COLUMNS, route_unmatched_to_unknown, to_fact, with_storage_partitions
from farebox.plans import marts
from farebox.session import apply_pipeline_conf, scratch_path
from farebox.sources import fixtures, lake, seeds
from farebox.sources.commits import CommittedTable, log_beside
from farebox.sources.raw import align_columns, read_aligned
from farebox.streaming import incremental

P = fixtures.FIXTURE_PARAMS
TABLE_NAME = "yellow_trips"
# Fixed values used by the named queries below.
ONE_MONTH = (1996, 1)
LATER_MONTH = (1999, 3)
ZONE = 7
LATE_MEMBERS = (264,)
FRESHNESS_AS_OF = dt.datetime(2024, 2, 1)
FRESHNESS_MAX_AGE = dt.timedelta(hours=24)


# ------------------------------------------------------------- workspace
class Workspace:
    """Stored tables of one (session, source dir), built on first use."""

    _lock = threading.Lock()
    _cache: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = scratch_path(spark, "ws")
        self._built: dict[str, object] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        try:
            app = spark.sparkContext.applicationId
        except Exception:  # Spark Connect: no SparkContext on the client
            app = str(id(spark))
        key = (app, sf_dir.rstrip("/"))
        with cls._lock:
            if key not in cls._cache:
                cls._cache[key] = cls(spark, sf_dir)
            return cls._cache[key]

    def _once(self, name: str, build: Callable[[], object]):
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    # the joined lines of all trips, for facts that are built from them in several runs
    def lines(self) -> DataFrame:
        def build():
            path = f"{self.root}/lines"
            fixtures.land_lines(self.spark, self.sf_dir, path)
            return path
        return self.spark.read.parquet(self._once("lines", build))

    def raw(self) -> DataFrame:
        return fixtures.trip_raw(self.spark, self.sf_dir, self.lines())

    # lake with every trip (source spelling, airport fee absent)
    def lake_full(self) -> str:
        def build():
            path = f"{self.root}/lake_full"
            lake.build_lake([fixtures.trip_source(self.spark, self.sf_dir)], path, "tpep_pickup_datetime")
            return path
        return self._once("lake_full", build)

    # the trip source landed as monthly files by arrival (dropoff) month
    def landing(self) -> str:
        def build():
            path = f"{self.root}/landing"
            lake.land_monthly(fixtures.trip_source(self.spark, self.sf_dir), path, "tpep_dropoff_datetime")
            return path
        return self._once("landing", build)

    # raw table after: load of the arrived trips, lake rebuilt with all
    # trips, incremental load. Returns (lake v2, raw, audit) paths.
    def incremental_raw(self) -> tuple[str, str, str]:
        def build():
            lake_path = f"{self.root}/lake_inc"
            raw_path = f"{self.root}/raw_inc"
            audit_path = f"{self.root}/audit_inc"
            src = lake.read_lake(self.spark, self.lake_full())
            arrived = src.where(F.col("tpep_dropoff_datetime") < ntz_literal(fixtures.FIXTURE_ARRIVAL_CUTOFF))
            lake.build_lake([arrived], lake_path, "tpep_pickup_datetime", rebalance=False)
            incremental.load_partitions(self.spark, lake_path, raw_path, audit_path, TABLE_NAME)
            lake.build_lake([src], lake_path, "tpep_pickup_datetime", rebalance=False)
            incremental.load_partitions(self.spark, lake_path, raw_path, audit_path, TABLE_NAME)
            return lake_path, raw_path, audit_path
        return self._once("incremental_raw", build)

    # raw table fully loaded twice (second run a full refresh), plus one
    # partition replaced a third time
    def replaced_raw(self) -> tuple[str, str]:
        def build():
            raw_path = f"{self.root}/raw_full"
            audit_path = f"{self.root}/audit_full"
            lake_path = self.lake_full()
            incremental.load_partitions(self.spark, lake_path, raw_path, audit_path, TABLE_NAME)
            incremental.load_partitions(self.spark, lake_path, raw_path, audit_path, TABLE_NAME,
                                        full_refresh=True)
            y, m = ONE_MONTH
            part = lake.read_partition(self.spark, lake_path, y, m)
            incremental.replace_partitions(self.spark, part, raw_path, audit_path, TABLE_NAME, rebalance=False)
            return raw_path, audit_path
        return self._once("replaced_raw", build)

    # the same lake after its first partition went missing
    def shrunk_lake(self) -> tuple[str, str]:
        def build():
            lake_path, _, audit_path = self.incremental_raw()
            path = f"{self.root}/lake_shrunk"
            src = align_columns(lake.read_lake(self.spark, lake_path))
            y, m = ONE_MONTH
            gone = (F.col("year") == y) & (F.col("month") == m)
            lake.build_lake([src.where(~F.coalesce(gone, F.lit(False)))], path, "tpep_pickup_datetime", rebalance=False)
            return path, audit_path
        return self._once("shrunk_lake", build)

    # monthly sources by dropoff month, half of them with another spelling
    # and another integer type; one stated month has no source
    def monthly_sources(self) -> list[str]:
        def build():
            src = fixtures.trip_source(self.spark, self.sf_dir)
            even = F.month("tpep_dropoff_datetime") % 2 == 0
            a, b = f"{self.root}/feed_a", f"{self.root}/feed_b"
            lake.land_monthly(src.where(F.coalesce(~even, F.lit(True))), a, "tpep_dropoff_datetime")
            other = src.where(even).withColumn("payment_type", F.col("payment_type").cast("int"))
            lake.land_monthly(other.toDF(*[c.lower() for c in other.columns]), b, "tpep_dropoff_datetime")
            return sorted(lake.list_sources(self.spark, a) + lake.list_sources(self.spark, b),
                          key=lambda p: p.rsplit("/", 1)[-1])
        return self._once("monthly_sources", build)

    # lake built from all monthly sources but the last (and one that is absent)
    def lake_of_months(self, name: str = "lake_months") -> tuple[str, list[str]]:
        def build():
            path = f"{self.root}/{name}"
            sources = self.monthly_sources()
            absent = [f"{sources[0].rsplit('/', 1)[0]}/file_month=1901-01"]
            present, missing = lake.existing_sources(self.spark, absent + sources[:-1])
            lake.build_lake([read_aligned(self.spark, present)], path, "tpep_pickup_datetime")
            return path, missing
        return self._once(name, build)

    # another one like it, to which the last is appended
    def lake_grown(self) -> str:
        def build():
            path, _ = self.lake_of_months("lake_to_grow")
            lake.append_to_lake(read_aligned(self.spark, self.monthly_sources()[-1:]), path, "tpep_pickup_datetime")
            return path
        return self._once("lake_grown", build)

    # first load: the trips that had arrived; second: all of them. For the
    # upsert, the first load also holds wrong tips and trips that are later
    # withdrawn; their months are loaded again.
    def fact_incremental(self, late: str) -> str:
        def build():
            path = f"{self.root}/fct_{late}"
            raw = self.raw()
            arrived = raw.where(F.col("tpep_dropoff_datetime") < ntz_literal(fixtures.FIXTURE_ARRIVAL_CUTOFF))
            if late == "upsert":
                wrong = arrived.withColumn("tip_amount", F.when(F.col("vendorid") == 1, F.col("tip_amount") + 7)
                                           .otherwise(F.col("tip_amount")))
                withdrawn = arrived.where("vendorid = 2").withColumn("vendorid", F.lit(99))
                arrived = wrong.unionByName(withdrawn)
                months = [(r["year"], r["month"]) for r in raw.select("year", "month").distinct().collect()]
            else:
                months = None
            incremental.build_fact(self.spark, arrived, P, path, late=late)
            incremental.build_fact(self.spark, raw, P, path, late=late, partitions=months)
            return path
        return self._once(f"fact_{late}", build)


    # drop, then an upsert of an early month and of one beyond the mark, then drop
    def fact_mixed(self) -> str:
        def build():
            path = f"{self.root}/fct_mixed"
            raw = self.raw()
            arrived = raw.where(F.col("tpep_dropoff_datetime") < ntz_literal(fixtures.FIXTURE_ARRIVAL_CUTOFF))
            incremental.build_fact(self.spark, arrived, P, path, late="drop")
            incremental.build_fact(self.spark, raw, P, path, late="upsert", partitions=[ONE_MONTH, LATER_MONTH])
            incremental.build_fact(self.spark, raw, P, path, late="drop")
            return path
        return self._once("fct_mixed", build)

    # a committed lake: the monthly sources appended in two loads, the first
    # ones given again with the second, and all of them once more
    def lake_of_appends(self) -> str:
        def build():
            path = f"{self.root}/lake_appends"
            sources = self.monthly_sources()
            for k in (1, 2, 2):
                lake.append_sources(self.spark, sources[:len(sources) * k // 2], path, "tpep_pickup_datetime", read_aligned)
            return path
        return self._once("lake_appends", build)

    # the same with every month's files packed to the target size
    def lake_packed(self) -> str:
        def build():
            path = f"{self.root}/lake_packed"
            sources = self.monthly_sources()
            for k in (1, 2):
                lake.append_sources(self.spark, sources[:len(sources) * k // 2], path, "tpep_pickup_datetime", read_aligned)
            lake.compact_lake(self.spark, path, slack=1)
            return path
        return self._once("lake_packed", build)

    # raw loaded from the arrived trips, the lake rebuilt with all, and the
    # partitions whose files have changed loaded again; with its summaries,
    # taken before and brought up to date after
    def reloaded_raw(self) -> tuple[CommittedTable, str]:
        def build():
            lake_path, raw_path, audit_path, sums = (f"{self.root}/{x}_rel" for x in ("lake", "raw", "audit", "sums"))
            src = lake.read_lake(self.spark, self.lake_full())
            arrived = src.where(F.col("tpep_dropoff_datetime") < ntz_literal(fixtures.FIXTURE_ARRIVAL_CUTOFF))
            raw = incremental.raw_table(self.spark, raw_path, audit_path, TABLE_NAME)
            for rows in (arrived, src):
                lake.build_lake([rows], lake_path, "tpep_pickup_datetime", rebalance=False)
                incremental.load_partitions(self.spark, lake_path, raw_path, audit_path, TABLE_NAME, reload_changed=True)
                summaries.refresh(self.spark, raw, sums)
            return raw, sums
        return self._once("reloaded_raw", build)

    # days as partitions
    def lake_daily(self) -> str:
        def build():
            path = f"{self.root}/lake_daily"
            lake.build_lake([fixtures.trip_source(self.spark, self.sf_dir)], path, "tpep_pickup_datetime", by=lake.DAILY)
            return path
        return self._once("lake_daily", build)

    # rows of a month dealt to its files by ranges of the pickup location
    def lake_clustered(self) -> str:
        def build():
            path = f"{self.root}/lake_clustered"
            lake.build_lake([fixtures.trip_source(self.spark, self.sf_dir)], path, "tpep_pickup_datetime",
                            cluster_by="PULocationID")
            return path
        return self._once("lake_clustered", build)

    # a fact routed against the zones, then again after a member has come
    def fact_rerouted(self) -> str:
        def build():
            path = f"{self.root}/fct_rerouted"
            fact, kept = (CommittedTable(self.spark, r, log_beside(r)) for r in (path, f"{path}_unmatched"))
            keys = ["pickup_location_id", "dropoff_location_id"]
            zones = _dim_location(self.spark, self.sf_dir)
            summaries.write_routed(fact, kept, with_storage_partitions(_fact(self.spark, self.sf_dir)), zones, "location_id", keys)
            late = seeds.inline_relation(self.spark, [(i,) for i in LATE_MEMBERS], "location_id int")
            summaries.reroute_new_members(fact, kept, zones.select("location_id").unionByName(late), "location_id", keys)
            return path
        return self._once("fct_rerouted", build)


# ------------------------------------------------------------- building blocks
def _raw(spark, sf):
    return fixtures.trip_raw(spark, sf)


def _stg(spark, sf):
    return staging.stg_trips(_raw(spark, sf), P)


def _fact(spark, sf):
    return to_fact(_stg(spark, sf))


def _dim_location(spark, sf):
    return dims.dim_location(fixtures.zone_seed(spark, sf), P.airport_zones)


def _prep(spark):
    apply_pipeline_conf(spark)


# ------------------------------------------------------------- queries
def q_top_pickup_zones(spark, sf):
    _prep(spark)
    return profile.top_pickup_zones(_fact(spark, sf), _dim_location(spark, sf))


def q_scan_pruned_columns(spark, sf):
    _prep(spark)
    li = fixtures.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    return li.agg(F.count("*").alias("rows"),
                  F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)").alias("sum_quantity"),
                  F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)")
                   .alias("sum_extendedprice"))


def q_lake_roundtrip_counts(spark, sf):
    _prep(spark)
    path = Workspace.of(spark, sf).lake_full()
    return profile.trips_by_month(lake.read_lake(spark, path))


def q_lake_one_month(spark, sf):
    _prep(spark)
    path = Workspace.of(spark, sf).lake_full()
    y, m = ONE_MONTH
    return lake.read_partition(spark, path, y, m, ["trip_distance", "total_amount"])


def q_lake_partitions(spark, sf):
    _prep(spark)
    return lake.lake_partitions(spark, Workspace.of(spark, sf).lake_full())


def q_lake_layout(spark, sf):
    """Rows per partition next to whether the layout lists files and bytes
    for it (their numbers depend on the writer's tasks)."""
    _prep(spark)
    path = Workspace.of(spark, sf).lake_full()
    layout = lake.lake_layout(spark, path).alias("f")
    rows = lake.read_lake(spark, path).groupBy("year", "month").agg(F.count("*").alias("rows")).alias("r")
    same = F.col("f.year").eqNullSafe(F.col("r.year")) & F.col("f.month").eqNullSafe(F.col("r.month"))
    return layout.join(rows, same).select("r.year", "r.month", "rows", (F.col("files") >= 1).alias("has_files"),
                                          (F.col("bytes") > 0).alias("has_bytes"))


def q_dataset_summary(spark, sf):
    _prep(spark)
    return lake.dataset_summary(spark, Workspace.of(spark, sf).lake_full()).drop("files")


def q_lake_from_monthly_files(spark, sf):
    _prep(spark)
    built, missing = Workspace.of(spark, sf).lake_of_months()
    return profile.trips_by_month(lake.read_lake(spark, built)).withColumn("absent_sources", F.lit(len(missing)))


def q_lake_append_month(spark, sf):
    _prep(spark)
    return profile.trips_by_month(lake.read_lake(spark, Workspace.of(spark, sf).lake_grown()))


def _event_sources(sf):
    (y1, m1), (y2, m2) = fixtures.EVENTS_STATED_MONTHS
    return [(y1, m1, fixtures.events_path(sf)),
            (y2, m2, f"{sf.rstrip('/')}/events_{y2:04d}-{m2:02d}.parquet")]


def q_source_file_counts(spark, sf):
    _prep(spark)
    return lake.source_file_counts(spark, _event_sources(sf))


def q_stray_dates(spark, sf):
    _prep(spark)
    return lake.stray_dates(spark, _event_sources(sf), "ts")


def q_stray_dates_trips(spark, sf):
    _prep(spark)
    root = Workspace.of(spark, sf).landing()
    return lake.stray_dates(spark, lake.stated_months(lake.list_sources(spark, root)), "tpep_pickup_datetime")


def q_aligned_raw(spark, sf):
    _prep(spark)
    path = Workspace.of(spark, sf).lake_full()
    return align_columns(lake.read_lake(spark, path))


def q_partition_replace(spark, sf):
    _prep(spark)
    raw_path, audit_path = Workspace.of(spark, sf).replaced_raw()
    return profile.trips_by_month(incremental.read_raw(spark, raw_path, audit_path, TABLE_NAME))


def q_audit_latest(spark, sf):
    _prep(spark)
    _, audit_path = Workspace.of(spark, sf).replaced_raw()
    return incremental.audit_latest(incremental.read_audit(spark, audit_path)).drop("loaded_at")


def q_incremental_load(spark, sf):
    _prep(spark)
    _, raw_path, audit_path = Workspace.of(spark, sf).incremental_raw()
    return profile.trips_by_month(incremental.read_raw(spark, raw_path, audit_path, TABLE_NAME))


def q_incremental_reload_changed(spark, sf):
    _prep(spark)
    raw, _ = Workspace.of(spark, sf).reloaded_raw()
    return profile.trips_by_month(raw.read())


def q_profile_from_summaries(spark, sf):
    """Counters and statistics merged from one kept row per partition."""
    _prep(spark)
    _, sums = Workspace.of(spark, sf).reloaded_raw()
    return summaries.profile_of(summaries.summary_table(spark, sums).read())


def q_trips_by_month_kept(spark, sf):
    _prep(spark)
    _, sums = Workspace.of(spark, sf).reloaded_raw()
    return summaries.trips_by_month(summaries.summary_table(spark, sums).read())


def q_check_signature_drift(spark, sf):
    _prep(spark)
    lake_path, audit_path = Workspace.of(spark, sf).shrunk_lake()
    return checks.check_signature_drift(spark, lake_path, audit_path, TABLE_NAME)


def q_dataset_structure(spark, sf):
    """Rows, nulls and bounds per partition and column of the raw table, from
    its footers; the load time is left out."""
    _prep(spark)
    raw, _ = Workspace.of(spark, sf).reloaded_raw()
    return raw.structure().where("column_name <> '_loaded_at'")


def q_lake_row_counts(spark, sf):
    """Rows per partition of the lake, from the footers."""
    _prep(spark)
    return lake.partition_counts(spark, Workspace.of(spark, sf).lake_full())


def q_lake_append_twice(spark, sf):
    _prep(spark)
    return profile.trips_by_month(lake.read_lake(spark, Workspace.of(spark, sf).lake_of_appends()))


def q_lake_compacted(spark, sf):
    """Rows per month of the packed lake, and whether its files are no more
    than the target size asks for."""
    _prep(spark)
    path = Workspace.of(spark, sf).lake_packed()
    layout = lake.lake_layout(spark, path).alias("f")
    rows = profile.trips_by_month(lake.read_lake(spark, path)).alias("r")
    same = F.col("f.year").eqNullSafe(F.col("r.year")) & F.col("f.month").eqNullSafe(F.col("r.month"))
    asked = F.ceil(F.col("bytes") / F.lit(lake.TARGET_FILE_BYTES))
    return layout.join(rows, same).select("r.year", "r.month", "trips", (F.col("files") <= asked).alias("packed"))


def q_lake_daily(spark, sf):
    """Days of the lake from its folder names, and their number of rows."""
    _prep(spark)
    path = Workspace.of(spark, sf).lake_daily()
    days = lake.lake_partitions(spark, path, lake.DAILY).alias("d")
    rows = lake.read_lake(spark, path).groupBy(*lake.DAILY).agg(F.count("*").alias("trips")).alias("r")
    same = F.lit(True)
    for c in lake.DAILY:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}"))
    return days.join(rows, same).select(*(f"d.{c}" for c in lake.DAILY), "trips")


def q_lake_clustered_zone(spark, sf):
    """One zone of one month: a partition filter and a pushed filter that the
    statistics of the month's files answer."""
    _prep(spark)
    y, m = ONE_MONTH
    df = lake.read_partition(spark, Workspace.of(spark, sf).lake_clustered(), y, m)
    return df.where(F.col("PULocationID") == ZONE).select("trip_distance", "total_amount")


def q_fct_incremental_mixed(spark, sf):
    _prep(spark)
    return lake.read_lake(spark, Workspace.of(spark, sf).fact_mixed()).select(*FACT_COLUMNS)


def q_fct_rerouted(spark, sf):
    _prep(spark)
    return lake.read_lake(spark, Workspace.of(spark, sf).fact_rerouted()).select(
        "trip_id", "pickup_location_id", "dropoff_location_id")


def q_check_audit_drift(spark, sf):
    _prep(spark)
    lake_path, audit_path = Workspace.of(spark, sf).shrunk_lake()
    latest = incremental.audit_latest(incremental.read_audit(spark, audit_path))
    return checks.check_audit_drift(latest, lake.read_lake(spark, lake_path), TABLE_NAME)


def q_stg_trips(spark, sf):
    _prep(spark)
    _stg(spark, sf).createOrReplaceTempView("stg_trips")   # S-17: a view stores nothing
    return spark.table("stg_trips")


def q_stg_dedup(spark, sf):
    _prep(spark)
    return staging.stg_trips(_raw(spark, sf), P, clean=False)


def q_stg_types(spark, sf):
    _prep(spark)
    return staging.renamed(_raw(spark, sf)).select(
        "trip_id", "rate_code_id", "passenger_count", "was_store_and_forward", "trip_duration_minutes")


def q_fct_trips(spark, sf):
    _prep(spark)
    return _fact(spark, sf)


def q_fct_incremental(spark, sf):
    _prep(spark)
    path = Workspace.of(spark, sf).fact_incremental("drop")
    return lake.read_lake(spark, path).select(*FACT_COLUMNS)


def q_fct_incremental_upsert(spark, sf):
    _prep(spark)
    path = Workspace.of(spark, sf).fact_incremental("upsert")
    return lake.read_lake(spark, path).select(*FACT_COLUMNS)


def q_fct_unmatched_to_unknown(spark, sf):
    _prep(spark)
    f = _fact(spark, sf)
    routed = route_unmatched_to_unknown(f, _dim_location(spark, sf), "location_id",
                                        ["pickup_location_id", "dropoff_location_id"])
    return routed.select("trip_id", "pickup_location_id", "dropoff_location_id")


def q_dim_date(spark, sf):
    _prep(spark)
    return dims.dim_date_covering(fixtures.table(spark, sf, "orders"), "o_orderdate")


def q_dim_location(spark, sf):
    _prep(spark)
    return _dim_location(spark, sf)


def q_payment_type_usage(spark, sf):
    _prep(spark)
    return profile.payment_type_usage(_fact(spark, sf), dims.dim_payment_type(spark))


def q_seed_csv_roundtrip(spark, sf):
    _prep(spark)
    ws = Workspace.of(spark, sf)

    def build():
        path = f"{ws.root}/seed_zones_csv"
        seeds.write_seed_csv(fixtures.zone_seed(spark, sf), path)
        return path
    path = ws._once("seed_csv", build)
    return dims.dim_location(seeds.read_seed_csv(spark, path), P.airport_zones)


def q_trips_by_month(spark, sf):
    _prep(spark)
    return profile.trips_by_month(_raw(spark, sf))


def q_busiest_hours(spark, sf):
    _prep(spark)
    return profile.busiest_hours(fixtures.events(spark, sf), "ts", "value")


def q_top_pickup_locations(spark, sf):
    _prep(spark)
    return profile.top_locations(_raw(spark, sf), "pulocationid")


def q_quality_counters(spark, sf):
    _prep(spark)
    return profile.quality_counters(_raw(spark, sf))


def q_global_stats(spark, sf):
    _prep(spark)
    return profile.global_stats(_raw(spark, sf))


def q_rows_kept_summary(spark, sf):
    _prep(spark)
    return profile.rows_kept_summary(_raw(spark, sf), _fact(spark, sf))


def q_rejects_by_rule(spark, sf):
    _prep(spark)
    return profile.rejects_by_rule(staging.renamed(_raw(spark, sf)), staging.cleaning_rules(P))


def q_weekend_revenue_by_quarter(spark, sf):
    _prep(spark)
    return profile.weekend_revenue_by_quarter(_fact(spark, sf), dims.dim_date(spark, P.start, P.end))


def q_tip_rate_reliable(spark, sf):
    _prep(spark)
    return profile.tip_rate_reliable(_fact(spark, sf), dims.dim_payment_type(spark))


def q_check_unique(spark, sf):
    _prep(spark)
    return checks.check_unique(staging.renamed(_raw(spark, sf)), "trip_id")


def q_check_not_null(spark, sf):
    _prep(spark)
    return checks.check_not_null(
        staging.renamed(_raw(spark, sf)),
        ["trip_id", "pickup_location_id", "dropoff_location_id", "payment_type_id", "passenger_count"])


def q_check_relationships(spark, sf):
    _prep(spark)
    return checks.check_relationships(_fact(spark, sf), {
        "pickup_location_id": (_dim_location(spark, sf), "location_id"),
        "dropoff_location_id": (_dim_location(spark, sf), "location_id"),
        "payment_type_id": (dims.dim_payment_type(spark), "payment_type_id"),
        "pickup_date_key": (dims.dim_date(spark, P.start, P.end), "date_key"),
    })


def q_check_model_keys(spark, sf):
    _prep(spark)
    ws = Workspace.of(spark, sf)
    fact = lake.read_lake(spark, ws.fact_incremental("upsert"))
    return checks.check_model_keys({
        "raw": (staging.renamed(ws.raw()), "trip_id"),
        "fct_trips": (fact, "trip_id"),
        "dim_location": (_dim_location(spark, sf), "location_id"),
        "dim_payment_type": (dims.dim_payment_type(spark), "payment_type_id"),
        "dim_date": (dims.dim_date_covering(fixtures.table(spark, sf, "orders"), "o_orderdate"), "date_key"),
    })


def q_check_load_freshness(spark, sf):
    """Just after its loads the pipeline is fresh; the same loads seen from
    two days later are not."""
    _prep(spark)
    _, audit_path = Workspace.of(spark, sf).replaced_raw()
    audit = incremental.audit_latest(incremental.read_audit(spark, audit_path))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = None
    for when, as_of in (("now", now), ("two days on", now + dt.timedelta(days=2))):
        row = checks.check_load_freshness(audit, as_of, FRESHNESS_MAX_AGE).withColumn("seen", F.lit(when))
        out = row if out is None else out.unionByName(row)
    return out


def q_stored_star_report(spark, sf):
    """The sample star query over stored tables: every model built once."""
    _prep(spark)
    ws = Workspace.of(spark, sf)

    def build():
        return marts.build_marts(spark, _raw(spark, sf), fixtures.zone_seed(spark, sf), P, f"{ws.root}/marts")
    m = ws._once("marts", build).read(spark)
    return profile.top_pickup_zones(m["fct_trips"], m["dim_location"])


def q_check_business_rules(spark, sf):
    _prep(spark)
    return checks.check_business_rules(staging.stg_trips(_raw(spark, sf), P, clean=False))


def q_check_reconciliation(spark, sf):
    _prep(spark)
    ws = Workspace.of(spark, sf)
    path = ws.fact_incremental("drop")
    return checks.check_reconciliation(staging.stg_trips(ws.raw(), P), lake.read_lake(spark, path))


def q_check_freshness(spark, sf):
    _prep(spark)
    return checks.check_freshness(fixtures.events(spark, sf), "ts", FRESHNESS_AS_OF, FRESHNESS_MAX_AGE)


def q_schema_change_gate(spark, sf):
    """A changed model is refused, and the stored fact is as it was."""
    _prep(spark)
    ws = Workspace.of(spark, sf)
    path = ws.fact_incremental("drop")

    def changed(stg):
        return to_fact(stg).withColumns({"passenger_count": F.col("passenger_count").cast("double"),
                                         "store_id": F.lit(None).cast("int")})
    try:
        incremental.build_fact(spark, ws.raw(), P, path, model=changed)
        refused = False
    except incremental.SchemaChangeError:
        refused = True
    return profile.trips_by_month(lake.read_lake(spark, path)).withColumn("refused", F.lit(refused))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_pickup_zones": q_top_pickup_zones,
    "scan_pruned_columns": q_scan_pruned_columns,
    "lake_roundtrip_counts": q_lake_roundtrip_counts,
    "lake_one_month": q_lake_one_month,
    "lake_partitions": q_lake_partitions,
    "lake_from_monthly_files": q_lake_from_monthly_files,
    "lake_append_month": q_lake_append_month,
    "lake_layout": q_lake_layout,
    "dataset_summary": q_dataset_summary,
    "source_file_counts": q_source_file_counts,
    "stray_dates": q_stray_dates,
    "stray_dates_trips": q_stray_dates_trips,
    "aligned_raw": q_aligned_raw,
    "partition_replace": q_partition_replace,
    "audit_latest": q_audit_latest,
    "incremental_load": q_incremental_load,
    "stg_trips": q_stg_trips,
    "stg_dedup": q_stg_dedup,
    "stg_types": q_stg_types,
    "fct_trips": q_fct_trips,
    "fct_incremental": q_fct_incremental,
    "fct_incremental_upsert": q_fct_incremental_upsert,
    "fct_unmatched_to_unknown": q_fct_unmatched_to_unknown,
    "dim_date": q_dim_date,
    "dim_location": q_dim_location,
    "payment_type_usage": q_payment_type_usage,
    "seed_csv_roundtrip": q_seed_csv_roundtrip,
    "trips_by_month": q_trips_by_month,
    "busiest_hours": q_busiest_hours,
    "top_pickup_locations": q_top_pickup_locations,
    "quality_counters": q_quality_counters,
    "global_stats": q_global_stats,
    "rows_kept_summary": q_rows_kept_summary,
    "rejects_by_rule": q_rejects_by_rule,
    "weekend_revenue_by_quarter": q_weekend_revenue_by_quarter,
    "tip_rate_reliable": q_tip_rate_reliable,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_relationships": q_check_relationships,
    "check_business_rules": q_check_business_rules,
    "check_reconciliation": q_check_reconciliation,
    "check_freshness": q_check_freshness,
    "check_audit_drift": q_check_audit_drift,
    "check_model_keys": q_check_model_keys,
    "check_load_freshness": q_check_load_freshness,
    "stored_star_report": q_stored_star_report,
    "schema_change_gate": q_schema_change_gate,
    "incremental_reload_changed": q_incremental_reload_changed,
    "profile_from_summaries": q_profile_from_summaries,
    "trips_by_month_kept": q_trips_by_month_kept,
    "check_signature_drift": q_check_signature_drift,
    "dataset_structure": q_dataset_structure,
    "lake_row_counts": q_lake_row_counts,
    "lake_append_twice": q_lake_append_twice,
    "lake_compacted": q_lake_compacted,
    "lake_daily": q_lake_daily,
    "lake_clustered_zone": q_lake_clustered_zone,
    "fct_incremental_mixed": q_fct_incremental_mixed,
    "fct_rerouted": q_fct_rerouted,
}

"""Mart build (S-18): the star schema materialised as tables.

Dimensions are small and rebuilt in full (overwrite); the fact is
maintained incrementally (see ``streaming.incremental.build_fact``).
Reports then read stored tables instead of recomputing the chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from farebox.operators import dims
from farebox.params import PipelineParams
from farebox.sources.lake import read_lake
from farebox.streaming.incremental import build_fact, load_partitions, note_absorbed, pending_loads, read_raw


@dataclass(frozen=True)
class Marts:
    root: str

    @property
    def fact(self) -> str:
        return f"{self.root}/fct_trips"

    @property
    def absorbed(self) -> str:
        """Ledger of the raw loads that the fact has taken in."""
        return f"{self.root}/fct_trips_absorbed"

    @property
    def dim_date(self) -> str:
        return f"{self.root}/dim_date"

    @property
    def dim_location(self) -> str:
        return f"{self.root}/dim_location"

    @property
    def dim_payment_type(self) -> str:
        return f"{self.root}/dim_payment_type"

    def read(self, spark: SparkSession, fact_path: str | None = None) -> dict[str, DataFrame]:
        return {
            "fct_trips": read_lake(spark, fact_path or self.fact),
            "dim_date": spark.read.parquet(self.dim_date),
            "dim_location": spark.read.parquet(self.dim_location),
            "dim_payment_type": spark.read.parquet(self.dim_payment_type),
        }


def write_table(df: DataFrame, path: str) -> None:
    """Table materialisation of a small model: full overwrite."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def build_dimensions(spark: SparkSession, zone_seed: DataFrame, params: PipelineParams, m: Marts) -> None:
    """The three dimensions as tables. Days and codes are one small file; the
    zone seed may be any frame, so it keeps its tasks."""
    write_table(dims.dim_date(spark, params.start, params.end).coalesce(1), m.dim_date)
    write_table(dims.dim_location(zone_seed, params.airport_zones), m.dim_location)
    write_table(dims.dim_payment_type(spark).coalesce(1), m.dim_payment_type)


def build_marts(spark: SparkSession, raw: DataFrame, zone_seed: DataFrame, params: PipelineParams,
                root: str, late: str = "drop") -> Marts:
    """Seed -> dimensions (tables) and raw -> staging -> fact (incremental)."""
    m = Marts(root)
    build_dimensions(spark, zone_seed, params, m)
    build_fact(spark, raw, params, m.fact, late=late)
    return m


def refresh_fact(spark: SparkSession, raw_root: str, audit_root: str, params: PipelineParams, fact_root: str,
                 ledger_root: str, table_name: str = "yellow_trips", late: str = "drop") -> list[tuple]:
    """The nightly run of the fact: ``build_fact`` on the partitions of every
    audited raw load that the ledger does not have, this night's or an earlier
    one's that died before its fact was written; the loads are noted after
    the fact's commit. With nothing to take in, the audit and the ledger are
    all that is read: neither raw table nor fact is opened.

    ``late="drop"`` needs no other partition: what the absorbed loads hold beyond
    the mark is in the fact, and what the mark has overtaken stays out by that
    rule. A load that was noted is not looked at again, so after a change of
    ``params`` or of the model the fact is to be built anew. Returns the (year,
    month) taken in."""
    pending = pending_loads(spark, audit_root, ledger_root, table_name).collect()   # one row per partition
    parts = sorted({(r["year"], r["month"]) for r in pending}, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or 0))
    if parts:
        build_fact(spark, read_raw(spark, raw_root, audit_root, table_name), params, fact_root, late=late, partitions=parts)
        note_absorbed(spark, ledger_root, table_name, sorted({r["load_id"] for r in pending}))
    return parts


def refresh_star(spark: SparkSession, lake_root: str, raw_root: str, audit_root: str,
                 zone_seed: DataFrame, params: PipelineParams, marts_root: str,
                 full_refresh: bool = False, table_name: str = "yellow_trips") -> Marts:
    """load -> seed/dimensions -> fact, as plain function composition.

    The fact is upserted for the partitions of every audited load that it has
    not taken in yet, this run's or an earlier one's that died before its
    fact was written; these loads are noted after the fact's commit."""
    load_partitions(spark, lake_root, raw_root, audit_root, table_name, full_refresh)
    m = Marts(marts_root)
    build_dimensions(spark, zone_seed, params, m)
    refresh_fact(spark, raw_root, audit_root, params, m.fact, m.absorbed, table_name, late="upsert")
    return m

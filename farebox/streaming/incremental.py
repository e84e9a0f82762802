"""Incremental, idempotent loading into committed tables (``sources.commits``).

* Raw load (S-09..S-12): lake partitions that the audit log lacks are
  copied to the raw table, into folders of the load's own; the audit rows are
  the commit. A run that dies before them leaves the old rows readable
  in full, and the next run loads the same partitions again.
* Fact (S-13): the first load writes everything. ``late="drop"`` (the
  reference's rule) appends staging rows newer than the stored mark;
  ``late="upsert"`` recomputes the (re)loaded (year, month) partitions and
  replaces exactly those, so corrected and removed rows take effect. The mark
  is part of the commit records: it always speaks of the rows that are there.
* The star notes which raw loads its fact has taken in (``absorbed``) after
  the fact's commit. Whatever dies in between is done again by the next run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.temporal import ntz_literal
from farebox.operators.fact import to_fact, with_storage_partitions
from farebox.operators.staging import stg_trips
from farebox.params import PipelineParams
from farebox.session import path_exists
from farebox.sources.commits import CommittedTable, log_beside, new_load_id, partition_predicate, read_log
from farebox.sources.lake import PARTITION_COLS, partition_signatures, read_lake
from farebox.sources.raw import LOADED_AT, RAW_SCHEMA, align_columns, with_load_timestamp
from farebox.sources.seeds import inline_relation

AUDIT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("row_count", T.LongType(), False),
    T.StructField("loaded_at", T.TimestampNTZType(), False),
    T.StructField("load_id", T.StringType(), False),
])


# ---------------------------------------------------------------- audit log
def read_audit(spark: SparkSession, audit_root: str) -> DataFrame:
    """S-10: the append-only audit log (empty if it does not exist yet)."""
    return read_log(spark, audit_root).where("kind = 'replace'").select(*AUDIT_SCHEMA.fieldNames())


def audit_latest(audit: DataFrame) -> DataFrame:
    """S-11: keyed upsert as a view: the newest row per (table, year, month)
    (max_by is a partial aggregate; no sort, no window)."""
    newest = F.max_by(F.struct("row_count", "loaded_at", "load_id"),
                      F.struct("loaded_at", "load_id"))
    return (audit.groupBy("table_name", "year", "month").agg(newest.alias("n"))
                 .select("table_name", "year", "month", "n.row_count", "n.loaded_at"))


# ------------------------------------------------------------ raw loading
def raw_table(spark: SparkSession, raw_root: str, audit_root: str, table_name: str = "yellow_trips") -> CommittedTable:
    """The raw table, whose commit records are the audit log."""
    return CommittedTable(spark, raw_root, audit_root, table_name)


def read_raw(spark: SparkSession, raw_root: str, audit_root: str, table_name: str = "yellow_trips") -> DataFrame:
    """The raw rows of the audited loads; without any, an empty raw table."""
    table = raw_table(spark, raw_root, audit_root, table_name)
    state = table.state()
    if state.columns is None:
        return inline_relation(spark, [], T.StructType(
            [f for f in RAW_SCHEMA.fields if f.name not in PARTITION_COLS]
            + [T.StructField(LOADED_AT, T.TimestampNTZType())] + [RAW_SCHEMA[c] for c in PARTITION_COLS]))
    return table.read(state)


def replace_partitions(spark: SparkSession, rows: DataFrame, raw_root: str, audit_root: str,
                       table_name: str = "yellow_trips", rebalance: bool = True) -> dict:
    """S-09: replace exactly the (year, month) partitions present in ``rows``
    (lake columns), in one commit with their audit rows."""
    return raw_table(spark, raw_root, audit_root, table_name).write(
        with_load_timestamp(align_columns(rows)), "replace", rebalance=rebalance)


def pending_partitions(spark: SparkSession, lake_root: str, audit_root: str, table_name: str,
                       full_refresh: bool = False, reload_changed: bool = False) -> DataFrame:
    """J-04: (year, month, signature) of the lake's partitions to load, from the
    listing and the audit alone: those without an audit row, with
    ``reload_changed`` also those whose files are not those that were loaded,
    with ``full_refresh`` all."""
    listed = partition_signatures(spark, lake_root)
    if full_refresh:
        return listed
    newest = F.max_by("signature", "seq").alias("done_signature")
    done = (read_log(spark, audit_root).where((F.col("table_name") == table_name) & (F.col("kind") == "replace"))
            .groupBy(*PARTITION_COLS).agg(newest, F.lit(True).alias("done")).alias("done"))
    # null-safe: the NULL-timestamp partition counts as loaded too
    same = (F.col("l.year").eqNullSafe(F.col("done.year")) & F.col("l.month").eqNullSafe(F.col("done.month")))
    todo = F.col("done").isNull()
    if reload_changed:
        todo = todo | ~F.col("signature").eqNullSafe(F.col("done_signature"))
    return listed.alias("l").join(done, same, "left").where(todo).select("l.year", "l.month", "l.signature")


def load_partitions(spark: SparkSession, lake_root: str, raw_root: str, audit_root: str,
                    table_name: str = "yellow_trips", full_refresh: bool = False,
                    partitions_per_commit: int | None = None, reload_changed: bool = False) -> DataFrame:
    """S-12 + J-04: load lake partitions missing from the audit (all with
    ``full_refresh``; with ``reload_changed`` also those whose files have
    changed since) into the raw table.

    The lake's folders are listed and compared with the audit; only the
    partitions left are opened and copied, without a shuffle (the lake is
    already partitioned by year/month). The rows take effect with their audit
    rows. Returns those of this run as (year, month, row_count).

    ``partitions_per_commit`` splits a large backfill into groups of
    partitions, each its own commit: a failure keeps the groups already done,
    and the next run resumes after them."""
    pending = pending_partitions(spark, lake_root, audit_root, table_name, full_refresh, reload_changed)
    todo = sorted(pending.collect(), key=lambda r: (r["year"] is not None, r["year"] or 0, r["month"] or 0))  # folder names
    done = []
    if todo:
        lake, table = read_lake(spark, lake_root), raw_table(spark, raw_root, audit_root, table_name)
        step, load_id = partitions_per_commit or len(todo), new_load_id()
        for i in range(0, len(todo), step):
            group = {(r["year"], r["month"]): r["signature"] for r in todo[i:i + step]}
            batch = lake.where(partition_predicate(list(group)))
            counts = table.write(with_load_timestamp(align_columns(batch)), "replace", list(group),
                                 rebalance=False, signatures=group, load_id=load_id)
            done += [(y, m, n) for (y, m), n in counts.items()]
    return inline_relation(spark, done, "year int, month int, row_count bigint")


# ------------------------------------------------------- incremental fact
class SchemaChangeError(RuntimeError):
    """Raised when new fact rows do not match the stored fact's schema."""


def schema_differences(target: T.StructType, new: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """C-08: (column, target type, new type) for every added, removed or
    retyped column, comparing names case-insensitively."""
    t = {f.name.lower(): f.dataType.simpleString() for f in target.fields}
    n = {f.name.lower(): f.dataType.simpleString() for f in new.fields}
    out = []
    for name in list(t) + [k for k in n if k not in t]:
        if t.get(name) != n.get(name):
            out.append((name, t.get(name), n.get(name)))
    return out


# ------------------------------------------------------------- ledgers
ABSORBED = "table_name string, load_id string"


def absorbed_loads(spark: SparkSession, ledger_root: str) -> DataFrame:
    """(table_name, load_id) of the raw loads that a consumer has taken in."""
    if not path_exists(spark, ledger_root):
        return inline_relation(spark, [], ABSORBED)
    return spark.read.schema(ABSORBED).parquet(ledger_root)


def pending_loads(spark: SparkSession, audit_root: str, ledger_root: str, table_name: str) -> DataFrame:
    """(year, month, load_id) of audited partitions whose load the consumer of
    ``ledger_root`` has not taken in."""
    audit = read_audit(spark, audit_root).where(F.col("table_name") == table_name)
    return audit.join(absorbed_loads(spark, ledger_root), ["table_name", "load_id"], "left_anti").select(
        *PARTITION_COLS, "load_id")


def note_absorbed(spark: SparkSession, ledger_root: str, table_name: str, load_ids: Sequence[str]) -> None:
    """Written after the consumer's own commit."""
    rows = inline_relation(spark, [(table_name, x) for x in load_ids], ABSORBED)
    rows.coalesce(1).write.mode("append").parquet(ledger_root)


# Fixed value: the mark used when the fact is empty.
HWM_DEFAULT = dt.datetime(1900, 1, 1)


def fact_table(spark: SparkSession, fact_root: str) -> CommittedTable:
    return CommittedTable(spark, fact_root, log_beside(fact_root))


def high_water_mark(spark: SparkSession, fact_root: str) -> dt.datetime | None:
    """A-07: ``max(pickup_at)`` of the stored fact: the largest of the marks that
    the live folders' commit records hold. No row is read. As a literal it
    prunes raw partitions at planning time and reaches the Parquet reader as a
    pushed filter."""
    return fact_table(spark, fact_root).state().mark


def build_fact(spark: SparkSession, raw: DataFrame, params: PipelineParams, fact_root: str,
               late: str = "drop", model: Callable[[DataFrame], DataFrame] = to_fact,
               partitions: Sequence[tuple[int | None, int | None]] | None = None) -> DataFrame:
    """S-13 + P-22 + A-07: materialise the fact from the raw table.

    First load (no committed one): staging -> fact, written partitioned by
    pickup month. Later ones:
    ``late="drop"`` (the reference's rule): trips with ``pickup_at`` later than
    the mark (1900-01-01 if the fact is empty) are appended; pickup time is
    part of the key, so no stored key can be among them and nothing stored is
    read. Without such a raw row nothing is written.
    ``late="upsert"``: the fact rows of ``partitions`` (the (year, month) list
    that was (re)loaded; required after the first load) are computed anew from raw and
    replace what the fact holds of them: keys that match are replaced, rows that are gone
    from raw go. A key never moves between partitions.
    Both may alternate: the mark is that of the rows that are live.
    ``model`` maps staging rows to fact rows; if its output schema differs
    from the stored fact, the run fails (C-08). Returns the stored fact."""
    if late not in ("drop", "upsert"):
        raise ValueError("late must be 'drop' or 'upsert'")
    table = fact_table(spark, fact_root)
    state = table.state()
    first = state.columns is None
    if late == "upsert" and not first and partitions is None:
        raise ValueError("an upsert needs the partitions that were loaded")
    if partitions is not None:
        if not {"year", "month"} <= set(raw.columns):
            raw = raw.withColumns({"year": F.year("tpep_pickup_datetime").cast("int"),
                                   "month": F.month("tpep_pickup_datetime").cast("int")})
        raw = raw.where(partition_predicate(list(partitions)))
    since = ntz_literal(state.mark or HWM_DEFAULT) if late == "drop" and not first else None
    new = model(stg_trips(raw, params, since=since))
    if not first:
        # C-08 on the rows this run would write (one plan, analysed once)
        diffs = schema_differences(state.columns, new.schema)
        if diffs:
            raise SchemaChangeError(f"fact schema changed: {diffs}")
        new = new.select(*state.columns.fieldNames())
    if late == "drop" and not first and stg_trips(raw, params, dedupe=False, since=since).isEmpty():
        return table.read(state)
    kind = "replace" if late == "upsert" and not first else "append"
    _, state = table.load(with_storage_partitions(new), kind, partitions or (), mark_col="pickup_at", state=state)
    return table.read(state)

"""Mergeable summaries per partition (A-01, A-04, A-05 kept, not recomputed).

A summary row holds, for one (year, month) of the raw table, counts, exact
decimal sums and extremes: all of them merge by sum, minimum or maximum, so
reports over the whole table read one row per partition. The summaries are a
committed table; the signature of a partition names the raw loads that it
sums up, so a refresh reads only partitions whose live loads have changed.

The set of location ids without a dimension row is kept the same way, as one
row per partition and id: a member that arrives late names the partitions of
the fact that have to be routed anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.numeric import exact_mean_2dp
from farebox.operators.fact import reroute, route_unmatched_to_unknown, with_source_ids
from farebox.sources.commits import PARTITION_COLS, CommittedTable, log_beside, partition_predicate

COUNTERS = ("negative_fares", "zero_distance", "absurd_distance", "zero_passengers", "null_passengers",
            "dropoff_before_pickup")


def summary_table(spark: SparkSession, root: str) -> CommittedTable:
    return CommittedTable(spark, root, log_beside(root))


def summarise(raw: DataFrame) -> DataFrame:
    """One row per partition."""
    dist, amount = F.col("trip_distance"), F.col("total_amount")
    pax = F.col("passenger_count")
    flags = dict(zip(COUNTERS, (amount < 0, dist <= 0, dist > 200, pax == 0, pax.isNull(),
                                F.col("tpep_dropoff_datetime") <= F.col("tpep_pickup_datetime"))))
    return raw.groupBy(*PARTITION_COLS).agg(
        F.count("*").alias("trips"), *(F.count_if(x).alias(c) for c, x in flags.items()),
        F.sum(dist.cast("decimal(38,6)")).alias("sum_distance"), F.count(dist).alias("n_distance"),
        F.sum(amount.cast("decimal(38,6)")).alias("sum_total"), F.count(amount).alias("n_total"),
        F.max(dist).alias("max_distance"), F.min(amount).alias("min_total"))


def refresh(spark: SparkSession, raw: CommittedTable, root: str) -> list[tuple]:
    """Bring the summaries at ``root`` up to date with the raw table: partitions
    whose live loads differ from those that were summed up are read and
    replaced, in one commit. Returns these partitions."""
    table = summary_table(spark, root)
    now: dict[tuple, list[str]] = {}
    raw_state = raw.state()
    for year, month, load in raw_state.live:
        now.setdefault((year, month), []).append(load)
    signatures = {p: ",".join(sorted(loads)) for p, loads in now.items()}
    known = {(r["year"], r["month"]): r["signature"] for r in table.log().where("kind = 'replace'")
             .groupBy(*PARTITION_COLS).agg(F.max_by("signature", "seq").alias("signature")).collect()}  # one row per partition
    touched = [p for p in {**known, **signatures} if signatures.get(p) != known.get(p)]
    if touched:
        rows = summarise(raw.read(raw_state).where(partition_predicate(touched)))
        table.write(rows, "replace", touched, signatures=signatures)
    return touched


def trips_by_month(summaries: DataFrame) -> DataFrame:
    """A-01."""
    return summaries.select(*PARTITION_COLS, "trips").orderBy(*PARTITION_COLS)


def profile_of(summaries: DataFrame) -> DataFrame:
    """A-04 + A-05 of the whole table, merged from its partitions."""
    merged = summaries.agg(*(F.sum(c).alias(c) for c in ("trips", *COUNTERS, "sum_distance", "n_distance", "sum_total", "n_total")),
                           F.max("max_distance").alias("max_distance"), F.min("min_total").alias("min_total"))
    return merged.select(
        "trips", *COUNTERS, exact_mean_2dp(F.col("sum_distance").cast("decimal(38,6)"), F.col("n_distance"), 6).alias("mean_distance"),
        exact_mean_2dp(F.col("sum_total").cast("decimal(38,6)"), F.col("n_total"), 6).alias("mean_total"),
        "max_distance", "min_total")


# ------------------------------------------------- members that arrive late
def unmatched_ids(fact: DataFrame, fks: Sequence[str], unknown: int = -1) -> DataFrame:
    """(year, month, id): ids of each partition that went to the unknown member."""
    ids = F.array(*(F.when((F.col(fk) == unknown) & (F.col(f"{fk}_source") != unknown), F.col(f"{fk}_source")) for fk in fks))
    return (fact.select(*PARTITION_COLS, F.explode(F.array_compact(ids)).alias("id")).distinct())


def write_routed(table: CommittedTable, kept: CommittedTable, fact: DataFrame, dim: DataFrame, dim_key: str,
                 fks: Sequence[str], mark_col: str = "pickup_at") -> None:
    """Store a fact (with year and month) whose unmatched keys are routed to the
    unknown member, its source ids beside them, and keep which ids went there."""
    table.write(route_unmatched_to_unknown(with_source_ids(fact, fks), dim, dim_key, fks), "replace", mark_col=mark_col)
    _keep_unmatched(table, kept, fks)


def _keep_unmatched(table: CommittedTable, kept: CommittedTable, fks: Sequence[str],
                    touched: Sequence[tuple] | None = None) -> None:
    rows = table.read() if touched is None else table.read().where(partition_predicate(touched))
    kept.write(unmatched_ids(rows, fks), "replace", touched or ())


def reroute_new_members(table: CommittedTable, kept: CommittedTable, dim: DataFrame, dim_key: str,
                        fks: Sequence[str], mark_col: str = "pickup_at") -> list[tuple]:
    """After members were added to ``dim``: route anew the partitions that hold
    an id of theirs, as the kept ids say, and no other. Returns them. A run
    that dies in between is repeated: the kept ids are replaced last."""
    new = dim.select(F.col(dim_key).alias("id")).distinct()
    touched = [(r["year"], r["month"]) for r in kept.read().join(new, "id", "left_semi")
               .select(*PARTITION_COLS).distinct().collect()]   # folder names
    if touched:
        rows = table.read().where(partition_predicate(touched))
        table.write(reroute(rows, dim, dim_key, fks), "replace", touched, mark_col=mark_col)
        _keep_unmatched(table, kept, fks, touched)
    return touched

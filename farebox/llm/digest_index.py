"""Exact dedup with a persistent digest index (operator 13).

The index is a table of distinct text digests, bucketed and sorted by digest.
New rows are grouped by digest first, so copies are one row a task before any
shuffle; a sort-merge anti-join with the index, which is never shuffled, finds
the digests it lacks, and these are appended. What a load adds to digests that
the index has (more copies, a larger id) goes to a second table with the same
buckets. A load counts once its name is in the ledger, written last: a load
that dies leaves nothing that is read, and may be added again.

Rows are resolved by the same buckets. A digest with more than 1 / ``HOT`` of
all rows, of which there are fewer than ``HOT``, is broadcast instead, so no
task gets a group of copies that grows with the table.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import path_exists, scratch_path

from .runtime import shuffle_width, stored

BUCKET_ROWS = 2_000_000    # digests of a bucket, about, when an index is made for given rows
HOT = 1024

ENTRY = "digest binary, keep_id bigint, keep_row bigint, n bigint, load string"
LOADS = "load string"


class DigestIndex:
    """At ``path``: ``digests`` (one row per digest, from the load that brought
    it), ``repeats`` (what later loads add to it) and the ledger ``loads``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        """Opens the index at ``path`` or makes one; ``buckets`` is fixed when it
        is made. The tables are known to the session's catalog by a name that
        is derived from the path."""
        self.spark, self.path, self.buckets = spark, path, buckets
        name = hashlib.sha256(path.encode()).hexdigest()[:16]
        self.digests, self.repeats = f"digests_{name}", f"repeats_{name}"
        for table in (self.digests, self.repeats):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ENTRY}) USING parquet "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                      f"LOCATION '{path}/{table.split('_')[0]}'")

    def loads(self) -> list[str]:
        """Names of the loads that count, one short string each."""
        if not path_exists(self.spark, f"{self.path}/loads"):
            return []
        return [r["load"] for r in self.spark.read.schema(LOADS).parquet(f"{self.path}/loads").distinct().collect()]

    def _read(self, table: str, loads: list[str]) -> DataFrame:
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table).filter(F.col("load").isin(loads) if loads else F.lit(False))

    def add(self, rows: DataFrame, load: str) -> None:
        """Take in ``rows`` (doc_id, digest, row) as the load of that name;
        ``row`` numbers the rows over all loads. A load that is in the index
        is not taken in again."""
        loads = self.loads()
        if load in loads:
            return
        best = F.max(F.struct("doc_id", "row"))   # a null id is below all others
        groups = stored(rows.groupBy("digest").agg(best.alias("keep"), F.count("*").alias("n"))
                        .select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"),
                                "n", F.lit(load).alias("load")), "digest-groups")
        known = self._read(self.digests, loads).select("digest")
        columns = [c.split()[0] for c in ENTRY.split(", ")]
        new = groups.join(known.hint("merge"), "digest", "left_anti")
        seen = groups.join(known.hint("merge"), "digest", "left_semi")
        for part, table in ((new, self.digests), (seen, self.repeats)):
            part.select(*columns).write.mode("append").insertInto(table)
        self.spark.range(1).select(F.lit(load).alias("load")).coalesce(1).write.mode("append").parquet(
            f"{self.path}/loads")

    def state(self) -> DataFrame:
        """(digest, keep_id, keep_row, n) over all loads that count: a merge of
        the two tables by their buckets, without a shuffle."""
        loads = self.loads()
        keep = F.struct("keep_id", "keep_row")
        later = (self._read(self.repeats, loads).groupBy("digest")
                 .agg(F.max(keep).alias("later"), F.sum("n").alias("more")))
        first = self._read(self.digests, loads)
        return (first.join(later.hint("merge"), "digest", "left")
                .withColumn("keep", F.greatest(keep, F.coalesce("later", keep)))
                .select("digest", "keep.keep_id", "keep.keep_row",
                        (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")))

    def resolve(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, digest, row) with keep_id, group_size and kept: true
        for the one row of each group that has the largest id (of rows that
        share it, the one with the largest ``row``). Rows that were never added
        have no group: keep_id null, group_size 0, kept false."""
        state = self.state()
        total = state.agg(F.sum("n")).first()[0] or 0
        hot = F.broadcast(stored(state.filter(F.col("n") * HOT > total), "digest-hot"))  # fewer than HOT rows
        often = rows.join(hot, "digest")
        other = rows.join(hot.select("digest"), "digest", "left_anti").join(state.hint("merge"), "digest", "left")
        kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("row").eqNullSafe(F.col("keep_row"))
        return often.unionByName(other).select(
            *rows.columns, "keep_id", F.coalesce("n", F.lit(0)).alias("group_size"), kept.alias("kept"))


def deduplicate(docs: DataFrame, path: str | None = None, batch: Column | None = None, batches: int = 1,
                text_col: str = "text") -> DataFrame:
    """(doc_id, digest, row, keep_id, group_size, kept) of each row of ``docs``:
    texts are equal if they are identical, a null text is the empty one, and of
    equal texts the row with the largest id stays (a null id is below all
    others; of rows that repeat the id as well, one stays).

    The rows are taken into the index at ``path`` (by default a new one below
    ``spark.checkpoint.dir``) in ``batches`` loads, by the value 0, 1, .. of
    ``batch``. An empty table gives no rows; further columns play no part."""
    spark = docs.sparkSession
    batch = F.lit(0) if batch is None else batch
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"),
                              F.monotonically_increasing_id().alias("row"), batch.alias("batch")), "digests")
    buckets = max(shuffle_width(spark), -(-rows.count() // BUCKET_ROWS))
    index = DigestIndex(spark, path or scratch_path(spark, "digest-index"), buckets)
    name = uuid.uuid4().hex[:12]
    for b in range(batches):
        index.add(rows.filter(F.col("batch") == b).drop("batch"), f"{name}-{b}")
    return index.resolve(rows.drop("batch"))

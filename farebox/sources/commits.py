"""Tables whose rows and commit record take effect together.

A table's rows lie in ``<root>/year=../month=../load_id=<id>/``. A load only
adds folders of its own; nothing that a reader may be using is moved or
deleted. The load takes effect when its rows are appended to the log: one
small file that says, per partition, how many rows the load wrote, the
largest value of the mark column among them, and whether they replace the
partition or add to it. Readers take the log's word: a partition is its
newest replacement and what was appended since. So a run that dies before
its log file leaves the table as it was, and a record can never outlive or
lag behind the rows that it speaks of.

One writer at a time; any number of readers. ``vacuum`` removes the folders of
replaced and unfinished loads.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.session import path_exists
from farebox.sources.seeds import inline_relation

PARTITION_COLS = ("year", "month")
LOAD = "load_id"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"   # the writer's folder for a NULL partition value

# kind: 'replace' or 'append' (rows of a partition), 'note' (a load without
# rows), 'source' (a file that the load has taken in).
LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("mark", T.TimestampNTZType()),
    T.StructField("columns", T.StringType()),
    T.StructField("signature", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.LongType()),
])


def partition_predicate(parts: Sequence[tuple[int | None, int | None]]) -> Column:
    """Predicate over the partition columns only (so it becomes
    ``PartitionFilters`` and prunes folders) selecting ``parts``."""
    keyed = sorted({y * 100 + m for y, m in parts if y is not None and m is not None})
    pred = (F.col("year") * 100 + F.col("month")).isin(keyed) if keyed else F.lit(False)
    if any(y is None or m is None for y, m in parts):
        pred = pred | F.col("year").isNull() | F.col("month").isNull()
    return pred


def new_load_id() -> str:
    return f"l{uuid.uuid4().hex}"   # a letter first: never taken for a number


def folder_key(year: int | None, month: int | None, load_id: str) -> str:
    return f"{'-' if year is None else year}/{'-' if month is None else month}/{load_id}"


def _folder_key_column() -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in PARTITION_COLS), LOAD)


@dataclass(frozen=True)
class State:
    """What a log says of a table: the live (year, month, load_id), the largest
    mark among them, the stored columns (None before the first load) and the
    number of the last load. One entry per live folder."""

    live: tuple[tuple[int | None, int | None, str], ...]
    mark: dt.datetime | None
    columns: T.StructType | None
    seq: int
    marks: tuple[dt.datetime | None, ...] = ()   # of the live folders, in their order

    def after(self, kind: str, load_id: str, written: dict, replaced: Sequence[tuple[int | None, int | None]],
              columns: T.StructType) -> State:
        """What the log says once it holds one more load: ``written`` is
        {(year, month): (rows, mark)}, ``replaced`` the partitions that hold
        nothing else then. So a writer need not read back the log it has written."""
        gone = {*replaced, *written} if kind == "replace" else set()
        kept = [(e, m) for e, m in zip(self.live, self.marks) if e[:2] not in gone]
        kept += [((*p, load_id), mark) for p, (n, mark) in written.items() if n]
        return State(tuple(e for e, _ in kept), max((m for _, m in kept if m is not None), default=None),
                     columns, self.seq + 1, tuple(m for _, m in kept))


def live_folders(state: State) -> Column:
    """Static partition filter of the live folders."""
    return _folder_key_column().isin([folder_key(*e) for e in state.live])


@dataclass(frozen=True)
class CommittedTable:
    spark: SparkSession
    root: str
    log_root: str
    name: str = "table"

    # ------------------------------------------------------------------ log
    def log(self) -> DataFrame:
        return read_log(self.spark, self.log_root).where(F.col("table_name") == self.name)

    def state(self) -> State:
        """One row per partition is collected; the live folders of a partition
        are its newest replacement and the appends after it."""
        folder = F.struct("seq", LOAD, "mark", "row_count")
        described = F.when(F.col("columns").isNotNull(), F.col("seq"))
        per_part = (self.log().where("kind <> 'source'").groupBy(*PARTITION_COLS)
                    .agg(F.max(F.when(F.col("kind") == "replace", F.col("seq"))).alias("base"),
                         F.collect_list(folder).alias("folders"), F.max("seq").alias("seq"),
                         F.max(F.struct(described, "columns")).alias("last")))
        base = F.coalesce("base", F.lit(-1))
        rows = per_part.select(*PARTITION_COLS, "seq", F.filter(
            "folders", lambda f: (f["seq"] >= base) & (f["row_count"] > 0)).alias("folders"), "last").collect()
        live = tuple((r["year"], r["month"], f[LOAD]) for r in rows for f in r["folders"])
        marks = tuple(f["mark"] for r in rows for f in r["folders"])
        last = max((r["last"] for r in rows if r["last"][0] is not None), key=lambda x: x[0], default=None)
        return State(live, max((m for m in marks if m is not None), default=None),
                     T.StructType.fromJson(json.loads(last[1])) if last else None,
                     max((r["seq"] for r in rows), default=-1), marks)

    # ----------------------------------------------------------------- read
    def read(self, state: State | None = None, file_col: str | None = None) -> DataFrame:
        """The table as the log has it; year and month are real columns. The
        live folders are a static partition filter, so no other folder is
        opened, and the schema is the log's: no file is opened for it.
        ``file_col`` adds the path of each row's file under that name."""
        state = state or self.state()
        columns = state.columns or T.StructType()
        parts = T.StructType([T.StructField(c, T.IntegerType()) for c in PARTITION_COLS])
        if not state.live:
            return inline_relation(self.spark, [], T.StructType([*columns.fields, *parts.fields]))
        schema = T.StructType([*columns.fields, *parts.fields, T.StructField(LOAD, T.StringType())])
        rows = (self.spark.read.schema(schema).option("basePath", self.root).parquet(self.root)
                .where(live_folders(state)))
        return (rows.withColumn(file_col, F.col("_metadata.file_path")) if file_col else rows).drop(LOAD)

    def structure(self) -> DataFrame:
        """S-21: (year, month, column_name, data_type, rows, nulls, min_value,
        max_value) of each partition and column. Bounds are given, as doubles,
        for numbers; other types have none. All counts, and the bounds of columns
        without a null, come from the footers; a row group of nulls alone has
        no bounds there, so columns that hold nulls are scanned for theirs."""
        state = self.state()
        columns = state.columns.fields if state.columns else []
        loads = self.log().where("columns is not null").agg(F.count_distinct("columns")).first()[0]
        if loads > 1:
            raise ValueError("loads of different columns have no common structure")
        out = "year int, month int, column_name string, data_type string, rows bigint, nulls bigint, min_value double, max_value double"
        if not state.live:
            return inline_relation(self.spark, [], out)
        schema = T.StructType([*columns, *(T.StructField(c, T.IntegerType()) for c in PARTITION_COLS), T.StructField(LOAD, T.StringType())])
        footers = footer_relation(self.spark, schema, self.root).where(live_folders(state))
        counts = [F.count("*").alias("rows"), *(F.count(f.name).alias(f"n_{f.name}") for f in columns)]
        whole = footers.groupBy(*PARTITION_COLS, LOAD).agg(*counts).agg(
            F.sum("rows").alias("rows"), *(F.sum(f"n_{f.name}").alias(f"n_{f.name}") for f in columns)).first()
        numbers = [f.name for f in columns if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType))]
        full = [c for c in numbers if whole[f"n_{c}"] == whole["rows"]]

        def bounds(names):
            return [g(c).alias(f"{g.__name__}_{c}") for c in names for g in (F.min, F.max)]
        # the footers answer per folder, i.e. by all partition columns; folders are merged then
        per_folder = footers.groupBy(*PARTITION_COLS, LOAD).agg(*counts, *bounds(full))
        holed = [c for c in numbers if c not in full]
        scanned = self.read(state).groupBy(*PARTITION_COLS).agg(*bounds(holed)) if holed else None
        parts = per_folder if scanned is None else per_folder.unionByName(scanned, allowMissingColumns=True)
        per_part = parts.groupBy(*PARTITION_COLS).agg(
            F.sum("rows").alias("rows"), *(F.sum(f"n_{f.name}").alias(f"n_{f.name}") for f in columns),
            *(g(f"{g.__name__}_{c}").alias(f"{g.__name__}_{c}") for c in numbers for g in (F.min, F.max)))
        none = F.lit(None).cast("double")

        def bound(name):   # a writer may note a bound of 0 as -0
            value = F.col(name).cast("double")
            return F.when(value == 0, F.lit(0.0)).otherwise(value)
        entry = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), "rows",
                          (F.col("rows") - F.col(f"n_{f.name}")).alias("nulls"),
                          *((bound(f"{g}_{f.name}") if f.name in numbers else none).alias(f"{g}_value")
                            for g in ("min", "max"))) for f in columns]
        return per_part.select(*PARTITION_COLS, F.explode(F.array(*entry)).alias("c")).select(*PARTITION_COLS, "c.*")

    # ---------------------------------------------------------------- write
    def write(self, rows: DataFrame, kind: str, partitions: Sequence[tuple[int | None, int | None]] = (),
              mark_col: str | None = None, rebalance: bool = True, state: State | None = None,
              signatures: dict | None = None, sources: Sequence[tuple[str, int, int]] = (),
              load_id: str | None = None) -> dict:
        """One load: ``rows`` (with year and month) are written to folders of
        their own and then committed. ``kind='replace'``: the partitions that
        the rows belong to and ``partitions`` hold exactly these rows then;
        ``'append'``: the rows are added. Returns {(year, month): rows}.

        ``rebalance=False`` writes without a shuffle, for rows that are read
        from a table that is partitioned the same way. A ``load_id`` may span
        several commits, of different partitions each."""
        return self.load(rows, kind, partitions, mark_col, rebalance, state, signatures, sources, load_id)[0]

    def load(self, rows: DataFrame, kind: str, partitions: Sequence[tuple[int | None, int | None]] = (),
             mark_col: str | None = None, rebalance: bool = True, state: State | None = None,
             signatures: dict | None = None, sources: Sequence[tuple[str, int, int]] = (),
             load_id: str | None = None) -> tuple[dict, State]:
        """``write`` that also returns the table's state after the load."""
        state = state or self.state()
        load_id = load_id or new_load_id()
        data = [f for f in rows.schema.fields if f.name not in PARTITION_COLS]
        out = rows.withColumn(LOAD, F.lit(load_id))
        if rebalance:
            out = out.hint("rebalance", *PARTITION_COLS)
        (out.write.mode("append").partitionBy(*PARTITION_COLS, LOAD)
            .option("compression", "snappy").parquet(self.root))
        written = self._written(load_id, data, mark_col, state)
        entries = [(self.name, y, m, n, kind, mark) for (y, m), (n, mark) in written.items()]
        if kind == "replace":
            entries += [(self.name, y, m, 0, kind, None) for y, m in dict.fromkeys(partitions) if (y, m) not in written]
        if not entries:
            entries = [(self.name, None, None, 0, "note", None)]
        columns = [T.StructType(data).json(), *[None] * (len(entries) - 1)]   # once a load
        log = [(*e[:4], load_id, state.seq + 1, e[4], e[5], c, (signatures or {}).get((e[1], e[2])), None, None, None)
               for e, c in zip(entries, columns)]
        log += [(self.name, None, None, 0, load_id, state.seq + 1, "source", None, None, None, *s) for s in sources]
        self._commit(log)
        if kind == "replace" and state.live:
            self.vacuum()
        return {p: n for p, (n, _) in written.items()}, state.after(kind, load_id, written, partitions, T.StructType(data))

    def _written(self, load_id: str, data: list[T.StructField], mark_col: str | None, state: State) -> dict:
        """{(year, month): (rows, mark)} of a load's new folders, from the footers
        and the mark column only."""
        known = {folder_key(*e) for e in state.live}
        folders = [f for f in list_folders(self.spark, f"{self.root}/*/*/{LOAD}={load_id}") if _key_of(f) not in known]
        if not folders:
            return {}
        schema = T.StructType([*(f for f in data if f.name == mark_col),
                               *(T.StructField(c, T.IntegerType()) for c in PARTITION_COLS),
                               T.StructField(LOAD, T.StringType())])
        if mark_col:
            rows = self.spark.read.schema(schema).option("basePath", self.root).parquet(*folders)
            mark = [F.max(mark_col).alias("mark")]
        else:
            rows, mark = footer_relation(self.spark, schema, self.root, folders), []
        found = rows.groupBy(*PARTITION_COLS, LOAD).agg(F.count("*").alias("n"), *mark).collect()   # one load
        return {(r["year"], r["month"]): (r["n"], r["mark"] if mark_col else None) for r in found}

    def _commit(self, entries: list[tuple]) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(*e[:4], now, *e[4:]) for e in entries]
        inline_relation(self.spark, rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.log_root)

    def vacuum(self) -> int:
        """Remove the folders of loads that the log does not have or that were
        replaced; returns how many. Readers that began before need them: on a
        table with long readers call it when they have ended."""
        live = {folder_key(*e) for e in self.state().live}
        gone = [f for f in list_folders(self.spark, f"{self.root}/*/*/{LOAD}=*") if _key_of(f) not in live]
        for f in gone:
            remove_path(self.spark, f)
        return len(gone)


def _key_of(folder: str) -> str:
    values = [x.split("=", 1)[1] for x in folder.rstrip("/").split("/")[-3:]]
    return "/".join("-" if v == NO_VALUE else v for v in values)


def footer_relation(spark: SparkSession, schema: T.StructType, root: str, paths: Sequence[str] = ()) -> DataFrame:
    """Parquet files through the reader that answers COUNT, MIN and MAX over
    whole partitions from the footers (``spark.sql.parquet.aggregatePushdown``):
    no row is decoded, if the grouping is by all partition columns. MIN and MAX
    go by a column's place, so all files must have exactly the columns of
    ``schema``; COUNT(*) needs none of them."""
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    try:   # which reader a relation has is settled when it is made
        spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1.split(",") if x.strip() != "parquet"))
        return spark.read.schema(schema).option("basePath", root).parquet(*(paths or [root]))
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", v1)


def read_log(spark: SparkSession, log_root: str) -> DataFrame:
    if not path_exists(spark, log_root):
        return inline_relation(spark, [], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(log_root)


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, through the Hadoop FileSystem; no data is read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [s.getPath().toString() for s in found or []]


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def log_beside(root: str) -> str:
    """The log of a table that keeps it within its own folder: it goes with it."""
    return f"{root.rstrip('/')}/_commits"


def committed(spark: SparkSession, root: str) -> CommittedTable | None:
    """The committed table at ``root``, if it is one."""
    log = log_beside(root)
    return CommittedTable(spark, root, log) if path_exists(spark, log) else None

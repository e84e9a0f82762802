"""Hive-partitioned Parquet lake: build, read, prune, inspect.

The partition columns come from the data's own timestamp, never from file
names. Writes go through a ``rebalance`` on the partition columns, so a
month lands in few, well-sized files, and AQE splits a month that holds a
large share of all rows over several writer tasks instead of one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.numeric import round_exact_ratio_2dp
from farebox.session import path_exists
from farebox.sources import commits
from farebox.sources.commits import PARTITION_COLS
from farebox.sources.seeds import inline_relation

# Bytes of a data file that a compaction aims at.
TARGET_FILE_BYTES = 256 << 20


# What a lake may be partitioned by: parts of the row's own timestamp.
PARTS_OF_TIME = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
DAILY = ("year", "month", "day")


def add_partition_columns(df: DataFrame, ts_col: str, by: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """P-10: year and month (int; or the parts ``by``) of the row's own
    timestamp. A NULL timestamp gives NULL partitions (Hive's default partition)."""
    return df.withColumns({c: PARTS_OF_TIME[c](ts_col).cast("int") for c in by})


def write_partitioned(df: DataFrame, root: str, mode: str = "append",
                      partition_cols: Sequence[str] = PARTITION_COLS) -> None:
    """S-05: partitioned snappy Parquet write. ``append`` adds files to
    existing folders; ``overwrite`` with the session's dynamic mode replaces
    only the partitions present in ``df``."""
    (df.hint("rebalance", *partition_cols)
       .write.mode(mode)
       .partitionBy(*partition_cols)
       .option("compression", "snappy")
       .parquet(root))


def append_to_lake(df: DataFrame, root: str, ts_col: str) -> None:
    """S-05: add rows to a lake: they are written next to what is there;
    nothing else is read or rewritten. Rows say nothing of where they come
    from, so appending them twice doubles them; ``append_sources`` does not."""
    df = add_partition_columns(df.drop(*PARTITION_COLS), ts_col)
    table = commits.committed(df.sparkSession, root)
    if table:
        table.write(df, "append")
    else:
        write_partitioned(df, root, mode="append")


def source_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, length, modified) of every Parquet file below ``paths``, from the
    file listing."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(list(paths))
            .select("path", "length", F.unix_micros("modificationTime").alias("modified")))


def append_sources(spark: SparkSession, paths: Sequence[str], root: str, ts_col: str,
                   read: Callable[[SparkSession, list[str]], DataFrame] | None = None) -> dict:
    """S-05 + U-02: add source files to the committed lake at ``root``, each
    once. The lake's log names every file that a load has taken in (path,
    length, modification time); the listing of ``paths`` is anti-joined with
    it, only files that are left are read, and their names are committed with
    their rows. So appending a source twice changes nothing, a source folder
    that has grown adds its new files, and a run that dies adds nothing.

    A file that was taken in and has changed since is an error: its rows cannot
    be told from those that it had. Rebuild the lake then. ``read`` turns
    paths into rows (default: plain Parquet). Returns {(year, month): rows}."""
    table = commits.CommittedTable(spark, root, commits.log_beside(root))
    present, _ = existing_sources(spark, paths)
    if not present:
        return {}
    taken = table.log().where("kind = 'source'").select("path", "length", "modified").distinct()
    files = source_files(spark, present)
    changed = files.alias("f").join(taken.alias("t"), "path").where(
        "f.length <> t.length or f.modified <> t.modified").select("path").limit(1).collect()
    if changed:
        raise ValueError(f"a source file has changed since it was appended: {changed[0]['path']}")
    new = files.join(taken, "path", "left_anti").collect()   # one row per new file, committed below
    if not new:
        return {}
    new_paths = sorted(r["path"] for r in new)
    rows = read(spark, new_paths) if read else spark.read.parquet(*new_paths)
    return table.write(add_partition_columns(rows.drop(*PARTITION_COLS), ts_col), "append",
                       sources=[(r["path"], r["length"], r["modified"]) for r in new])


def compact_lake(spark: SparkSession, root: str, target_bytes: int = TARGET_FILE_BYTES, slack: float = 2) -> list[tuple]:
    """S-05 + S-20: rewrite the partitions of the committed lake at ``root`` that
    lie in more than ``slack`` times the files that ``target_bytes`` asks for.

    A partition's files are put into bins of about the target size by their
    listed lengths; a row's bin is that of its file, and each bin is written by
    one task as one file. The rewrite is one load that replaces these
    partitions, so readers see the old files or the new ones. Returns the
    partitions that were rewritten."""
    table = commits.CommittedTable(spark, root, commits.log_beside(root))
    files = lake_files(spark, root)
    per_part = files.groupBy(*PARTITION_COLS).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    todo = per_part.where(F.col("files") > F.lit(slack) * F.ceil(F.col("bytes") / F.lit(target_bytes))).collect()
    parts = [(r["year"], r["month"]) for r in todo]   # folder names
    if not parts:
        return []
    before = Window.partitionBy(*PARTITION_COLS).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(before), F.lit(0))
    bins = (files.where(commits.partition_predicate(parts))
            .select(F.regexp_replace("path", "^file:/+", "file:/").alias("_file"), F.floor(start / target_bytes).alias("_bin")))
    state = table.state()
    rows = table.read(state, "_file").where(commits.partition_predicate(parts))
    # one row per file goes to every task: the rows are shuffled once, to their bins
    binned = rows.withColumn("_file", F.regexp_replace("_file", "^file:/+", "file:/")).join(F.broadcast(bins), "_file")
    count = sum(-(-r["bytes"] // target_bytes) for r in todo)
    dealt = binned.repartition(int(count), *PARTITION_COLS, "_bin").drop("_file", "_bin")
    table.write(dealt, "replace", parts, rebalance=False, state=state)
    return parts


def build_lake(sources: Iterable[DataFrame], root: str, ts_col: str, cluster_by: str | None = None,
               by: Sequence[str] = PARTITION_COLS, rebalance: bool = True) -> None:
    """S-06 + U-02: full rebuild from all source files in ONE job, partitioned
    by the parts ``by`` of the timestamp (e.g. ``DAILY``).

    ``cluster_by``: rows of a partition are dealt to its files by ranges of that
    column and sorted by it (bounds are sampled), so that the statistics of
    files and row groups prune a filter on it within a month.

    ``rebalance=False`` writes without a shuffle, for rows that are read from a
    lake that is partitioned the same way.

    All sources are unioned by name (missing columns become NULL) and the
    whole lake is rewritten with a static overwrite, so re-running never
    duplicates rows. Sources that do not exist should be left out by the
    caller (see ``existing_sources``)."""
    frames = list(sources)
    if not frames:
        raise ValueError("no source to build the lake from")
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    df = add_partition_columns(df.drop(*by), ts_col, by)
    if cluster_by:
        df = df.repartitionByRange(*by, cluster_by).sortWithinPartitions(*by, cluster_by)
    elif rebalance:
        df = df.hint("rebalance", *by)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "static")
       .partitionBy(*by)
       .option("compression", "snappy")
       .parquet(root))


def existing_sources(spark: SparkSession, paths: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split source paths into (present, missing); a missing month is
    reported, not fatal."""
    present, missing = [], []
    for p in paths:
        (present if path_exists(spark, p) else missing).append(p)
    return present, missing


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """S-03: the whole lake as one table; year/month are real columns. A lake
    without a file is a table without rows, of the partition columns only (of
    all its columns, if it is a committed table)."""
    table = commits.committed(spark, root)
    if table:
        return table.read()
    try:
        return spark.read.option("basePath", root).parquet(root)
    except AnalysisException as e:
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return inline_relation(spark, [], T.StructType([T.StructField(c, T.IntegerType()) for c in PARTITION_COLS]))


def read_partition(spark: SparkSession, root: str, year: int, month: int,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """S-04 / P-11: partition-pruned and column-pruned scan. The equality on
    the partition columns becomes ``PartitionFilters`` (only that folder is
    listed and read); the projection becomes ``ReadSchema``."""
    df = read_lake(spark, root).where((F.col("year") == year) & (F.col("month") == month))
    return df.select(*columns) if columns else df


def lake_files(spark: SparkSession, root: str, by: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """One row per data file: partition values, path, bytes and modification
    time. The rows come from the file listing, the partition from the path; no
    file is opened. An empty or absent lake has no rows; of a committed lake
    only the live files are listed."""
    if not path_exists(spark, root):
        ints = ", ".join(f"{c} int" for c in by)
        return inline_relation(spark, [], f"{ints}, path string, length long, modified long")
    files = source_files(spark, [root])
    table = commits.committed(spark, root)
    if table:
        live = [commits.folder_key(*e) for e in table.state().live]
        key = F.regexp_replace("path", r".*/year=([^/]+)/month=([^/]+)/load_id=([^/]+)/.*", "$1/$2/$3")
        files = files.where(F.replace(key, F.lit(commits.NO_VALUE), F.lit("-")).isin(live))
    pattern = ".*/" + "/".join(f"{c}=([^/]+)" for c in by) + "/.*"
    parts = [F.expr(f"try_cast(regexp_extract(path, '{pattern}', {i}) as int)").alias(c) for i, c in enumerate(by, 1)]
    return files.select(*parts, "path", "length", "modified")


def partition_signatures(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, signature): of each partition, what the listing says of its
    files: their number, bytes and a sum of hashes of (name, bytes, time). It
    changes when a file is added, removed or rewritten; no file is opened."""
    name = F.element_at(F.split("path", "/"), -1)
    mixed = F.xxhash64(name, "length", "modified").cast("decimal(38,0)")
    return (lake_files(spark, root).groupBy(*PARTITION_COLS)
            .agg(F.concat_ws(":", F.count("*").cast("string"), F.sum("length").cast("string"),
                             F.sum(mixed).cast("string")).alias("signature")))


def lake_partitions(spark: SparkSession, root: str, by: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """S-07 / O-03: sorted distinct (year, month), from the folder names."""
    return lake_files(spark, root, by).select(*by).distinct().orderBy(*by)


def partition_counts(spark: SparkSession, root: str, parts: Sequence[tuple] | None = None) -> DataFrame:
    """(year, month, rows) of the lake's partitions (of ``parts``, if given),
    from the footers: no row is decoded, and no file of another partition is
    opened."""
    ints = [T.StructField(c, T.IntegerType()) for c in PARTITION_COLS]
    if not path_exists(spark, root) or lake_files(spark, root).isEmpty():
        return inline_relation(spark, [], T.StructType([*ints, T.StructField("rows", T.LongType())]))
    table, keys = commits.committed(spark, root), list(PARTITION_COLS)
    if table:
        keys.append(commits.LOAD)
        rows = commits.footer_relation(spark, T.StructType([*ints, T.StructField(commits.LOAD, T.StringType())]), root)
        rows = rows.where(commits.live_folders(table.state()))
    else:
        rows = commits.footer_relation(spark, T.StructType(ints), root)
    if parts is not None:
        rows = rows.where(commits.partition_predicate(parts))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("rows"))   # by all partition columns: from the footers
    return counts.groupBy(*PARTITION_COLS).agg(F.sum("rows").alias("rows")) if table else counts


def newest_partition(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """The last (year, month) that has a file, from the folder names."""
    last = lake_files(spark, root).agg(F.max(F.col("year") * 100 + F.col("month"))).first()[0]
    return None if last is None else (last // 100, last % 100)


def lake_layout(spark: SparkSession, root: str) -> DataFrame:
    """S-20: files and bytes per partition, from the file listing only."""
    return (lake_files(spark, root).groupBy("year", "month")
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
            .orderBy("year", "month"))


def dataset_summary(spark: SparkSession, root: str) -> DataFrame:
    """S-21: rows, columns, partitions and files of a stored dataset. Files and
    partitions come from the listing; the count decodes no data column."""
    df = read_lake(spark, root)
    listed = lake_files(spark, root)
    files = listed.agg(F.count("*")).scalar()
    partitions = listed.select(F.struct(*PARTITION_COLS).alias("p")).distinct().agg(F.count("*")).scalar()
    return df.agg(F.count("*").alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), partitions.alias("partitions"), files.alias("files"))


def dataset_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """S-21: (position, name, type) of a dataset's columns."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return inline_relation(spark, rows, "position int, column_name string, data_type string")


# Fixed value: monthly source files carry their month as YYYY-MM in the name
# (e.g. "<type>_tripdata_2024-01.parquet").
MONTH_IN_NAME = re.compile(r"(\d{4})-(\d{2})(?:\.parquet)?/?$")


# The folder in which Spark's writer puts rows without a partition value.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def stated_months(paths: Iterable[str]) -> list[tuple[int | None, int | None, str]]:
    """(year, month, path) for source files named ``..._YYYY-MM.parquet``. The
    source of rows without a time states no month: (None, None, path), so all
    its rows count as stray. Other names are rejected."""
    out = []
    for p in paths:
        if p.rstrip("/").endswith(NO_MONTH):
            out.append((None, None, p))
            continue
        m = MONTH_IN_NAME.search(p)
        if not m:
            raise ValueError(f"no YYYY-MM month in source name: {p}")
        out.append((int(m.group(1)), int(m.group(2)), p))
    return out


def land_monthly(df: DataFrame, root: str, ts_col: str) -> None:
    """Land rows as monthly source files (one folder per month of
    ``ts_col``, named ``file_month=YYYY-MM``), like a feed that delivers one
    file per month. One partitioned write; rows without a time are kept in
    the default partition."""
    (df.withColumn("file_month", F.date_format(ts_col, "yyyy-MM"))
       .hint("rebalance", "file_month")
       .write.mode("overwrite").partitionBy("file_month").parquet(root))


def list_sources(spark: SparkSession, root: str) -> list[str]:
    """Sorted sub-folders / files directly below ``root`` (a directory
    listing through the Hadoop FileSystem, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    names = [st.getPath().toString() for st in fs.listStatus(p)]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def _source_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _uri(spark: SparkSession, path: str) -> str:
    """A path's URI in the form that ``_metadata.file_path`` has."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return _plain_uri(p.getFileSystem(conf).makeQualified(p).toUri().toString())


def _plain_uri(uri: str) -> str:
    return re.sub("^file:/+", "file:/", uri).rstrip("/")


def _tagged_sources(spark: SparkSession, sources: Sequence[tuple[int | None, int | None, str]],
                    ts_col: str | None = None) -> DataFrame | None:
    """Row counts of all present sources from ONE scan (reading only
    ``ts_col``, or no data column at all), per source (its stated year,
    month and name) and, with ``ts_col``, per year and month of that
    column (``ts_year``, ``ts_month``; NULL for a NULL time), in ``n``.

    Rows are counted per file path first (partial aggregation in every
    task). A file belongs to the source whose path is the file itself or the
    longest of its parent folders: each counted file meets the source list
    under all its prefixes, as URIs, so no decoding is involved. A file
    without a source is an error, never a lost row."""
    present, _ = existing_sources(spark, [p for _, _, p in sources])
    if not present:
        return None
    present_set = set(present)
    tags = [(_uri(spark, p), y, m, _source_name(p)) for y, m, p in sources if p in present_set]
    tag_df = inline_relation(spark, tags, "prefix string, year int, month int, file_name string")
    ts_parts = ["ts_year", "ts_month"] if ts_col else []
    ts_cols = [F.year(ts_col).alias("ts_year"), F.month(ts_col).alias("ts_month")] if ts_col else []
    per_file = (spark.read.option("recursiveFileLookup", "true").parquet(*present)
                .select(F.col("_metadata.file_path").alias("file"), *ts_cols)
                .groupBy("file", *ts_parts).agg(F.count("*").alias("n")))
    steps = F.split(F.regexp_replace("file", "^file:/+", "file:/"), "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)),
                           lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    files = per_file.select("file").distinct().select("file", F.explode(prefixes).alias("prefix"))
    source = (files.join(tag_df, "prefix", "left").groupBy("file")
              .agg(F.max_by(F.struct("year", "month", "file_name"),
                            F.when(F.col("file_name").isNotNull(), F.length("prefix"))).alias("s")))
    found = F.when(F.col("s.file_name").isNull(), F.raise_error(
        F.concat(F.lit("no source for the scanned file "), "file"))).otherwise(F.col("s.file_name"))
    return (per_file.join(source, "file")
            .select("s.year", "s.month", found.alias("file_name"), *ts_parts, "n"))


def source_file_counts(spark: SparkSession, expected: Sequence[tuple[int, int, str]]) -> DataFrame:
    """S-19 + A-09: row count per expected source (year, month, path).

    Present sources are read in one scan that decodes no data column (row
    counts come from the Parquet footers) and counted per source; the
    expected list is merged in (union + max) so a missing month shows up with ``rows``
    NULL and ``is_missing`` true. ``total_rows`` repeats the grand total on
    every row (a scalar subquery over the per-source counts)."""
    exp = inline_relation(spark, [(y, m, _source_name(p), None) for y, m, p in expected],
                          "year int, month int, file_name string, rows bigint")
    tagged = _tagged_sources(spark, expected)
    if tagged is None:
        counts = inline_relation(spark, [], "year int, month int, file_name string, rows bigint")
    else:
        counts = tagged.groupBy("year", "month", "file_name").agg(F.sum("n").alias("rows"))
    # expected rows carry NULL counts; present sources add theirs (no join)
    keys = ["year", "month", "file_name"]
    out = exp.unionByName(counts).groupBy(*keys).agg(F.max("rows").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return out.select("year", "month", "file_name", "rows",
                      F.col("rows").isNull().alias("is_missing"),
                      total.alias("total_rows"))


def stray_dates(spark: SparkSession, sources: Sequence[tuple[int | None, int | None, str]], ts_col: str) -> DataFrame:
    """C-07 / A-06: per source file, rows inside the file's stated month and
    rows outside it (a NULL timestamp counts as outside), with the share.
    One scan over all sources (only ``ts_col`` is read), counted per file
    and month of ``ts_col`` before anything else."""
    rows = _tagged_sources(spark, sources, ts_col)
    if rows is None:
        return inline_relation(spark, [], "year int, month int, file_name string, rows bigint, "
                                          "in_month bigint, stray bigint, stray_pct decimal(18,2)")
    in_month = F.coalesce((F.col("ts_year") == F.col("year")) & (F.col("ts_month") == F.col("month")),
                          F.lit(False))
    agg = rows.groupBy("year", "month", "file_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(in_month, F.col("n")).otherwise(F.lit(0).cast("bigint"))).alias("in_month"),
    )
    stray = F.col("rows") - F.col("in_month")
    return agg.select(
        "year", "month", "file_name", "rows", "in_month", stray.alias("stray"),
        round_exact_ratio_2dp(stray.cast("decimal(38,0)"), F.col("rows").cast("decimal(38,0)"), 0, 100)
        .alias("stray_pct"))

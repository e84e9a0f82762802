"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the pipeline relies on. ANSI stays on (Spark 4 default):
# every ratio is guarded explicitly, and bad casts should fail loudly.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # counts and bounds of whole partitions come from the footers, where a
    # relation asks for the reader that can (commits.footer_relation)
    "spark.sql.parquet.aggregatePushdown": "true",
    # a writing task keeps this many partitions' files open and sorts only what is
    # left: rows that come a few months a task are not sorted in memory at all
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


# Settings of a cluster (100 TB class inputs), where the caller sets none: start with
# many shuffle partitions and let AQE coalesce them to ~256 MB each; split
# skewed partitions; read ~256 MB per scan task.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "farebox", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests. On a cluster, pass the cluster's
    master; ``CLUSTER_CONF`` then holds unless ``extra`` says otherwise."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**session_conf(master, shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_pipeline_conf(spark)
    return spark


def session_conf(master: str, shuffle_partitions: int) -> dict[str, str]:
    """Settings of a session: ``shuffle_partitions`` on one machine, those of
    ``CLUSTER_CONF`` elsewhere."""
    if master.startswith("local"):
        return {**PIPELINE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    return {**PIPELINE_CONF, **CLUSTER_CONF}


def apply_pipeline_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. the one a
    scheduler hands us). Only SQL confs are touched."""
    for k, v in PIPELINE_CONF.items():
        spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """Root folder on storage every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine (``local[..]``: tests, bench)
    gets a folder of its own; on a cluster there is no safe guess, so it is
    an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share: stored tables and checkpoints go there")
        root = os.path.join(tempfile.gettempdir(), f"farebox-{os.getuid()}")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root for one job's tables."""
    return f"{shared_root(spark)}/farebox/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path, so it works
    for HDFS/S3/ABFS as well as local files. A file system that cannot be
    reached is an error, never "absent"."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))

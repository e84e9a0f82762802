"""Session helpers of the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from farebox.session import shared_root

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (a cluster ships it with ``--py-files`` or installs it)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, known) if x)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts
    the lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/farebox/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

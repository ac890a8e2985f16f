"""Scans of the input tables.

Each table is one Parquet dataset.  Scans stay lazy so Catalyst can push
filters and prune columns into the reader (``ReadSchema`` shows it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name == "events":
        # TIMESTAMP_NTZ is refused by watermarks; the session time zone is UTC
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df


SPREAD_MAX_BYTES = 1 << 30  # inputs above this are left as scanned (never reshuffled)


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Give a small text scan enough tasks.

    A scan with fewer splits than the cluster has cores (one big file with one
    row group, as in the test data) is spread by a hash of ``keys`` so every
    core gets work; the hash keeps placement deterministic on task retries.
    Only inputs up to ``SPREAD_MAX_BYTES`` (Catalyst's size estimate of the
    scan) are spread: a large input is assumed to be laid out for parallel
    reads and is never moved, so at scale this is a no-op and costs nothing.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_MAX_BYTES or df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)

"""Stored file catalogue: S1, S3, S4, S6 over one table, content encrypted at rest.

``files`` is a Parquet table dealt by ``bucket``, a hash of the file id, and sorted by a finer hash and the id
inside each file.  Listing reads the metadata columns and nothing of the content; a point
lookup names the bucket and the id, so partitions, row groups and pages without it are skipped;
a deletion rewrites only the buckets that hold a deleted file.

``content_enc`` is the text under the file's own data key (see ``operators.datakeys``).  The plain text is in no
stored column.

Deleting is two steps: the remaining rows of the touched buckets are written to a staging
folder, which are then moved to the place of the buckets.  A run that was killed in between leaves a
complete staging folder, which the next call puts in place first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shroud.session import exists

META = ("file_id", "file_code", "source_kind", "uri", "name", "n_chars", "created_at")
BUCKETS = 64


def bucket_of(file_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(file_id), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _meet(rows: DataFrame, narrow: DataFrame, col: str, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` (with ``file_id``) and the value ``col`` that ``narrow`` (``file_id``, ``col``) has for the file, null if none;
    dealt by slots of ``bucket`` and sorted by bucket, slot and id.

    Rows and values go through one shuffle and one sort as one table, and meet beside each other.  A join would move and
    sort the content by the id first, and then a second time by its bucket."""
    kind = narrow.schema[col].dataType
    both = rows.withColumns({"__value": F.lit(None).cast(kind), "__row": F.lit(True)}).unionByName(
        narrow.where(F.col("file_id").isNotNull()).select("file_id", F.col(col).alias("__value"), F.lit(False).alias("__row")),
        allowMissingColumns=True)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # a bucket is dealt in as many slots as there are tasks for it, so that a task can sort its rows in memory
    slot = bucket_of(F.col("file_id"), buckets * max(tasks // buckets, 1))
    dealt = both.withColumns({"bucket": bucket_of(F.col("file_id"), buckets), "__slot": slot}).repartition(tasks, "__slot")
    met = dealt.withColumn(col, F.max("__value").over(Window.partitionBy("bucket", "__slot", "file_id")))
    return met.where("__row").drop("__value", "__row", "__slot")


def write_files(files: DataFrame, root: str, data_keys: DataFrame, masters: DataFrame, buckets: int = BUCKETS) -> None:
    """Store ingested files (``META`` and ``content``), each encrypted with its data key.  The text moves once, to its bucket."""
    from shroud.operators.datakeys import opened_keys
    rows = _meet(files.select(*META, "content"), opened_keys(data_keys, masters).select("file_id", "dek"), "dek", buckets)
    enc = F.aes_encrypt(F.col("content"), F.col("dek"), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), F.col("file_id").cast("binary"))
    rows.select(*META, enc.alias("content_enc"), "bucket").write.partitionBy("bucket").parquet(f"{root}/files")


def stored(spark: SparkSession, root: str) -> DataFrame:
    finish_pending(spark, root)
    return spark.read.parquet(f"{root}/files")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """S3: metadata of all files."""
    return stored(spark, root).select(*META)


def file_metadata(spark: SparkSession, root: str, ids, buckets: int = BUCKETS) -> DataFrame:
    """Point lookup.  Ids in a list become filters on bucket and id (both reach the reader); a table of
    ids is a semi join on bucket and id."""
    table = stored(spark, root)
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col("file_id").alias("__id")).distinct().withColumn("__b", bucket_of(F.col("__id"), buckets))
        return table.join(wanted, (table["bucket"] == wanted["__b"]) & (table["file_id"] == wanted["__id"]), "left_semi").select(*META)
    ids = [str(i) for i in ids if i is not None]
    if not ids:
        return table.where(F.lit(False)).select(*META)
    # constant folding turns the hashes into literals, which prune partitions
    return table.where(F.col("bucket").isin([bucket_of(F.lit(i), buckets) for i in ids]) & F.col("file_id").isin(ids)).select(*META)


def finish_pending(spark: SparkSession, root: str) -> None:
    """Put a complete staging folder in place (after a run that was killed while it did so).

    Its buckets are moved, not written again.  A staged bucket that is no longer there has been moved before,
    unless the staging folder never had it: then nothing is left in the bucket."""
    staging = f"{root}/staging"
    if exists(spark, f"{staging}/rows/_SUCCESS") and exists(spark, f"{staging}/touched/_SUCCESS"):
        touched = spark.read.schema("bucket int, has_rows boolean").parquet(f"{staging}/touched").collect()  # at most one row per bucket
        if any(r["has_rows"] is None for r in touched):  # staged by a former version: rows in one folder
            left = spark.read.parquet(f"{staging}/rows")
            kept = {r["bucket"] for r in left.select("bucket").distinct().collect()}
            left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{root}/files")
            touched = [{"bucket": r["bucket"], "has_rows": r["bucket"] in kept} for r in touched]
        for r in touched:
            part = f"bucket={r['bucket']}"
            if r["has_rows"] is False:  # nothing is left in it
                remove_path(spark, f"{root}/files/{part}")
            elif exists(spark, f"{staging}/rows/{part}"):
                remove_path(spark, f"{root}/files/{part}")
                fs, staged = _fs(spark, f"{staging}/rows/{part}")
                if not fs.rename(staged, _fs(spark, f"{root}/files/{part}")[1]):
                    raise OSError(f"{staging}/rows/{part} can't be put in place")
    if exists(spark, staging):
        remove_path(spark, staging)


def delete_files(spark: SparkSession, root: str, ids: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Remove the files with these ids; returns the buckets that were rewritten.  The content moves and is written once."""
    table = stored(spark, root)
    gone = ids.select("file_id").where(F.col("file_id").isNotNull()).distinct()
    met = gone.withColumnRenamed("file_id", "__id").withColumn("__b", bucket_of(F.col("__id"), buckets))
    found = table.select("bucket", "file_id").join(met, (table["bucket"] == met["__b"]) & (table["file_id"] == met["__id"]), "left_semi")
    touched = sorted(r["bucket"] for r in found.select("bucket").distinct().collect())
    if not touched:
        return []
    rows = table.where(F.col("bucket").isin(touched)).drop("bucket")
    left = _meet(rows, gone.withColumn("gone", F.lit(True)), "gone", buckets).where("gone IS NULL").drop("gone")
    left.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/staging/rows")
    # which buckets still have rows, as the staged folders tell
    state = [(b, exists(spark, f"{root}/staging/rows/bucket={b}")) for b in touched]
    spark.createDataFrame(state, "bucket int, has_rows boolean").write.mode("overwrite").parquet(f"{root}/staging/touched")
    finish_pending(spark, root)
    return touched

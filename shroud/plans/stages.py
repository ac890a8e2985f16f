"""Stage result tables (J12): every stage of the workflow writes what became of each file.

``stages/<stage>`` holds ``file_id, error`` (null: passed), written by the stage itself next to its
output; a stage only sees what its predecessor passed.  Tables are written once (a run's folder is new),
so a job that dies between stages leaves the finished ones readable.  Requests and tokens meet as
narrow rows; the text is read by the detection and by the redaction, and moves in neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators import redact as R
from shroud.plans import workflow as W
from shroud.session import exists
from shroud.sources import files as FS

STAGES = ("uploaded", "detected", "redacted", "downloaded")
STAGE_DDL = "file_id string, error string"


def _record(rows: DataFrame, root: str, stage: str) -> DataFrame:
    path = f"{root}/stages/{stage}"
    rows.select("file_id", "error").write.parquet(path)
    return rows.sparkSession.read.schema(STAGE_DDL).parquet(path)


def _passed(stage: DataFrame) -> DataFrame:
    return stage.where(F.col("error").isNull()).select("file_id")


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upload(documents: DataFrame, keys: DataFrame, created_at, root: str) -> DataFrame:
    """S1; a document without text is recorded, its file isn't stored."""
    files = FS.ingest_local(documents, keys, created_at)
    _record(files.select("file_id", F.when(F.col("content").isNull(), "no text").alias("error")), root, "uploaded")
    return _store(files.where(F.col("content").isNotNull()), f"{root}/files")


def detect(files: DataFrame, tombstones: DataFrame, dictionary: DataFrame, cfg: W.WorkflowConfig, root: str) -> DataFrame:
    """D1-D7 on the files still there; a file deleted since its upload is recorded."""
    found = _store(W.detect_step(FS.delete_files(files, tombstones), dictionary, cfg), f"{root}/detected")
    gone = found.select(F.col("file_id").alias("__fid"), F.lit(True).alias("__found"))
    uploaded = _passed(files.sparkSession.read.schema(STAGE_DDL).parquet(f"{root}/stages/uploaded"))
    rows = uploaded.join(gone, F.col("file_id") == F.col("__fid"), "left")
    _record(rows.select("file_id", F.when(F.col("__found").isNull(), "file not found").alias("error")), root, "detected")
    return found


def redact(found: DataFrame, checked: DataFrame, cfg: W.WorkflowConfig, root: str) -> DataFrame:
    """R4 on the files whose redaction request (R3: ``file_id, reason``) was accepted; a file without request is recorded."""
    req = checked.select(F.col("file_id").alias("__rid"), "reason").withColumn("__asked", F.lit(True))
    rows = found.select("file_id").join(req, F.col("file_id") == F.col("__rid"), "left")
    stage = _record(rows.select("file_id", F.when(F.col("__asked").isNull(), "no request").otherwise(F.col("reason")).alias("error")),
                    root, "redacted")
    kept = found.join(_passed(stage), "file_id", "left_semi")
    done = R.apply_redactions(kept, "content", "findings", cfg.style, out="redacted_text", merged=True, stable=True)
    return _store(done.drop("content"), f"{root}/redacted")


def deliver(redacted: DataFrame, requests: DataFrame, keys: DataFrame, ttl_minutes: int, root: str) -> DataFrame:
    """S5 on the redacted files; a file nobody asked for is recorded."""
    meta = redacted.select("file_id", "key_id", "created_at", "n_chars", F.lit(None).cast("string").alias("content"))
    asked = requests.join(redacted.select("file_id"), "file_id", "left_semi")
    granted, refused = FS.download(meta, asked, keys, ttl_minutes)
    per = (granted.select("file_id", F.lit(None).cast("string").alias("reason")).unionByName(refused).groupBy("file_id")
           .agg(F.min(F.struct(F.col("reason").isNotNull().alias("bad"), "reason")).alias("b")))  # one grant is enough
    rows = redacted.select("file_id").join(per.select(F.col("file_id").alias("__rid"), "b"), F.col("file_id") == F.col("__rid"), "left")
    stage = _record(rows.select("file_id", F.when(F.col("b").isNull(), "no request").otherwise(F.col("b.reason")).alias("error")),
                    root, "downloaded")
    return redacted.join(_passed(stage), "file_id", "left_semi").select("file_id", "findings", "redacted_text")


def results(spark: SparkSession, root: str) -> DataFrame:
    """Every stage row of a run: stage, file_id, error.  A stage that hasn't run has no rows."""
    out = None
    for stage in STAGES:
        path = f"{root}/stages/{stage}"
        rows = spark.read.schema(STAGE_DDL).parquet(path) if exists(spark, path) else spark.createDataFrame([], STAGE_DDL)
        rows = rows.select(F.lit(stage).alias("stage"), "file_id", "error")
        out = rows if out is None else out.unionByName(rows)
    return out


def funnel(results: DataFrame) -> DataFrame:
    """Files passed and failed by stage; a stage without rows counts zeros."""
    counts = results.groupBy(F.col("stage").alias("__s")).agg(F.count_if(F.col("error").isNull()).alias("ok"),
                                                             F.count_if(F.col("error").isNotNull()).alias("bad"))
    names = results.sparkSession.createDataFrame([(s,) for s in STAGES], "stage string")
    return names.join(counts, F.col("stage") == F.col("__s"), "left").select(
        "stage", F.coalesce("ok", F.lit(0)).alias("n_ok"), F.coalesce("bad", F.lit(0)).alias("n_failed"))


def stage_errors(results: DataFrame) -> DataFrame:
    return results.where(F.col("error").isNotNull()).groupBy("stage", "error").agg(F.count("*").alias("n_files"))

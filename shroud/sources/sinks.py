"""Sinks: annotations S7, redacted output S8, raw job JSON S9, saved redactions S10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.sources.files import redacted_name


def write_annotations(annotations: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One annotation row per document, also with zero findings, partitioned by job.

    Dynamic partition overwrite: re-running a job (after a failure) replaces
    that job's partition only, so annotations are never duplicated."""
    writer = (annotations.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("job_id"))
    if fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def read_annotations(spark: SparkSession, path: str, job_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    # a job filter prunes partitions (PartitionFilters) instead of reading all jobs
    return df.where(F.col("job_id") == job_id) if job_id else df


def write_redacted(redacted: DataFrame, path: str, name_col: str = "name",
                   text_col: str = "redacted_text", id_col: str = "file_id") -> None:
    """Redacted text addressed by the file's id, with the derived output name.

    Names need not be unique (the id is); a file without a name is named by its id."""
    name = F.coalesce(F.nullif(redacted_name(F.col(name_col)), F.lit("")), F.concat(F.col(id_col).cast("string"), F.lit("_redacted")))
    (redacted.select(F.col(id_col), name.alias("redacted_name"), F.col(text_col))
     .write.mode("overwrite").parquet(path))


def save_results_json(jobs_json: DataFrame, path: str) -> None:
    """The raw job responses, one JSON document per line."""
    jobs_json.select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def load_redactions_json(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """Saved JSON files for R1.  ``wholetext`` reads one whole file per row
    (a pretty-printed document spans lines); otherwise one JSON per line."""
    # the keyword, not .option(): text() re-applies its own wholetext=False default
    return (spark.read.text(path, wholetext=wholetext)
            .select(F.input_file_name().alias("source_file"), F.col("value").alias("json")))

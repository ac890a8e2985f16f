"""T1 as two writes: a request is accepted with a reference first and answered later.

Every micro-batch writes the ``inProgress`` rows (narrow: the texts aren't read) before
its detection starts, then the results.  Both writes go to a folder of the batch's
number, which a batch that is run again after a failure overwrites, so a restart leaves one row of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.session import exists

ACCEPTED_DDL = "job_id string, status string, fdf_file_id string"
RESULT_DDL = f"{ACCEPTED_DDL}, n_redactions int, error string"


def _job(key: str):
    return F.concat(F.lit("detect-"), F.col(key).cast("string")), F.concat(F.lit("fdf-"), F.col(key).cast("string"))


def accepted(docs: DataFrame, key: str) -> DataFrame:
    job, ref = _job(key)
    return docs.select(job.alias("job_id"), F.lit("inProgress").alias("status"), ref.alias("fdf_file_id"))


def answered(docs: DataFrame, key: str, text_col: str, patterns=P.DEFAULT) -> DataFrame:
    """A null text is an ``error`` answer, anything else ``finished`` with its number of findings."""
    job, ref = _job(key)
    found = D.merge(D.detect_patterns(docs, text_col, patterns))
    bad = F.col(text_col).isNull()
    return found.select(job.alias("job_id"), F.when(bad, "error").otherwise("finished").alias("status"), ref.alias("fdf_file_id"),
                        F.when(~bad, F.size("findings")).alias("n_redactions"), F.when(bad, "no text").alias("error"))


def run_two_phase(docs: DataFrame, path: str, checkpoint: str, key: str = "doc_id", text_col: str = "text", after_accept=None) -> None:
    """Run the stream over what is available.  ``after_accept(epoch)`` is called between the two writes."""
    def sink(batch: DataFrame, epoch: int) -> None:
        accepted(batch, key).write.mode("overwrite").parquet(f"{path}/accepted/epoch={epoch}")
        if after_accept is not None:
            after_accept(epoch)
        answered(batch, key, text_col).write.mode("overwrite").parquet(f"{path}/answers/epoch={epoch}")
    q = docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    q.awaitTermination()


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path) if exists(spark, path) else spark.createDataFrame([], ddl)


def job_states(spark: SparkSession, path: str) -> DataFrame:
    """What a poll returns now (J3): the answer if there is one, else the accepted row; the reference is the
    first answer's (J5).  Both folders are joined on the narrow job id."""
    first = _read(spark, f"{path}/accepted", ACCEPTED_DDL).select("job_id", F.col("status").alias("first_status"), "fdf_file_id")
    last = _read(spark, f"{path}/answers", RESULT_DDL).select(F.col("job_id").alias("__job"), "status", "n_redactions", "error")
    return first.join(last, F.col("job_id") == F.col("__job"), "left").select(
        "job_id", "first_status", "fdf_file_id", F.coalesce("status", "first_status").alias("status"), "n_redactions", "error")

"""Registered queries over the stored catalogue: S3, S4, S6, encrypted download S5, key rotation, W1 on stored files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators import datakeys as DK
from shroud.operators import keywords as K
from shroud.operators import protect as PR
from shroud.plans import q_files as QF
from shroud.plans import workflow as W
from shroud.plans.q_workflow import _ROW_DECISIONS, ORACLE_WORKFLOW
from shroud.plans.registry import register
from shroud.session import scratch_path
from shroud.sources import catalogue as C
from shroud.sources import files as FS
from shroud.sources.tables import spread, table

_STORES: dict[tuple, str] = {}


def _new_store(spark: SparkSession, files: DataFrame) -> str:
    """Files ingested into a new store: data keys first, then the ciphertext."""
    root = scratch_path(spark, "stores", uuid.uuid4().hex)
    masters = PR.load_or_create_keys(spark)
    keys = DK.create(files.select("file_id"), masters, root)
    C.write_files(files, root, keys, masters)
    return root


def store(spark: SparkSession, sf_dir: str) -> str:
    """The store of all documents and pages of a folder, ingested once per application (nothing changes it: queries
    that delete or rotate make their own)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        _STORES[key] = _new_store(spark, QF._all_files(spark, sf_dir))
    return _STORES[key]


def _local_store(spark: SparkSession, sf_dir: str) -> str:
    return _new_store(spark, QF._local_files(spark, sf_dir))


@register("stored_list", sql=QF._ALL_META)
def stored_list(spark, sf_dir):
    return FS.list_files(C.list_files(spark, store(spark, sf_dir)))


@register("stored_metadata",
          sql=f"SELECT * FROM ({QF._ALL_META}) AS m WHERE file_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)")
def stored_metadata(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("file_id"))
    return FS.list_files(C.file_metadata(spark, store(spark, sf_dir), ids))


@register("stored_delete",
          sql=f"SELECT * FROM ({QF._ALL_META}) AS m WHERE file_id NOT IN (SELECT file_id FROM {QF._DELETED})")
def stored_delete(spark, sf_dir):
    root = _new_store(spark, QF._all_files(spark, sf_dir))
    C.delete_files(spark, root, QF._tombstones(spark, sf_dir))
    return FS.list_files(C.list_files(spark, root))


# ---- S5 ----
def requests_for(meta: DataFrame, tokens: DataFrame) -> DataFrame:
    """Derived requests, as in the other download queries: some tokens altered, some late."""
    t = tokens.withColumnRenamed("file_id", "__tid")
    return meta.select("file_id", "n_chars").join(t, F.col("file_id") == F.col("__tid")).select(
        "file_id", F.when(F.expr(QF.BAD_TOKEN_RULE), F.concat(F.lit("x"), "dek_token")).otherwise(F.col("dek_token")).alias("dek_token"),
        (F.lit(QF.INGESTED_AT).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.expr(QF.DELAY_RULE).cast("int"))).alias("requested_at"))


_TEXT_REQ = f"(SELECT r.*, d.text FROM ({QF._REQ}) AS r JOIN documents AS d ON CAST(d.doc_id AS VARCHAR) = r.file_id)"


@register("download_content",
          sql=(f"SELECT file_id, CASE WHEN ({QF._REASON}) IS NULL THEN sha256(text) END AS sha256, {QF._REASON} AS reason FROM {_TEXT_REQ} AS r"))
def download_content(spark, sf_dir):
    """Requests against the encrypted store: content (its hash) for the granted, a reason for the others."""
    root = _local_store(spark, sf_dir)
    masters, keys = PR.load_or_create_keys(spark), DK.data_keys(spark, root)
    # the requests were made before the deletion
    requests_for(C.list_files(spark, root), DK.issue_tokens(keys)).write.parquet(f"{root}/requests")
    req = spark.read.parquet(f"{root}/requests")
    C.delete_files(spark, root, QF._tombstones(spark, sf_dir))
    files = C.stored(spark, root)
    checked = DK.check_requests(files, req, keys, masters)
    return DK.download(files, checked).select("file_id", F.sha2("content", 256).alias("sha256"), "reason")


@register("rotate_keys", sql=("SELECT CAST(doc_id AS VARCHAR) AS file_id, sha256(text) AS sha256, "
                              "CAST(NULL AS VARCHAR) AS reason, 'old key version' AS old_token FROM documents"))
def rotate_keys(spark, sf_dir):
    """Every master key version is replaced; the same ciphertext opens with new tokens, and old tokens are refused."""
    root = _local_store(spark, sf_dir)
    masters = PR.load_or_create_keys(spark)
    before = DK.issue_tokens(DK.data_keys(spark, root))
    new = PR.load_or_create_keys(spark, scratch_path(spark, "shroud-next-keys")).select(F.concat(F.lit("n"), "key_id").alias("key_id"), "slot", "master")
    both = masters.unionByName(new)
    for k in sorted(r["key_id"] for r in PR.checked_keys(masters).collect()):
        DK.rotate(spark, root, both, k, "n" + k)
    keys, files = DK.data_keys(spark, root), C.stored(spark, root)
    at = lambda tokens: tokens.withColumn("requested_at", F.lit(QF.INGESTED_AT).cast("timestamp"))
    # the former masters are gone
    opened = DK.download(files, DK.check_requests(files, at(DK.issue_tokens(keys)), keys, new))
    old = DK.check_requests(files, at(before), keys, new).select(F.col("file_id").alias("__oid"), F.col("reason").alias("old_token"))
    return opened.join(old, F.col("file_id") == F.col("__oid")).select("file_id", F.sha2("content", 256).alias("sha256"), "reason", "old_token")


# ---- W1 on stored files ----
@register("workflow_stored", sql=ORACLE_WORKFLOW)
def workflow_stored(spark, sf_dir):
    """Ingest, detect, review, redact and download, with the text encrypted at rest.  Deletion, review flags, requests and
    keys meet as narrow rows first; the ciphertext of the files that are delivered is then read and opened once."""
    root = _local_store(spark, sf_dir)
    masters, keys = PR.load_or_create_keys(spark), DK.data_keys(spark, root)
    req = requests_for(C.list_files(spark, root), DK.issue_tokens(keys))
    files = C.stored(spark, root)
    live = files.select("file_id", "created_at").join(QF._tombstones(spark, sf_dir).distinct(), "file_id", "left_anti")
    granted = DK.check_requests(live, req, keys, masters).where(F.col("reason").isNull())
    flags = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("__lid"), "quality", "toxic")
    narrow = granted.join(flags, F.col("file_id") == F.col("__lid"), "left").select(F.col("file_id").alias("__gid"), "dek", "quality", "toxic")
    texts = files.select("file_id", "n_chars", "content_enc").join(narrow, F.col("file_id") == F.col("__gid")).select(
        "file_id", "n_chars", "quality", "toxic", DK.decrypt(F.col("content_enc"), F.col("dek"), F.col("file_id")).alias("content"))
    cfg = W.WorkflowConfig()
    found = W.detect_step(spread(texts, "file_id"), K.keyword_dictionary(spark), cfg)
    done = W.redact_step(W.review_on_row(found, lambda: F.expr(_ROW_DECISIONS)), cfg.style)
    return done.select(F.col("file_id").cast("bigint").alias("doc_id"), F.size("findings").alias("n_redactions"), "redacted_text")

"""Upload -> detect -> review -> redact -> download, as one Spark job.

Every step is a DataFrame transformation; nothing is collected in between.
Text rides on its row the whole way: detection, merging and redaction are
narrow projections.  The joins (tokens, deletions, review decisions, download
requests) all use the file id, so once the text side is partitioned by it the
later joins reuse that partitioning instead of moving the text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import ner as N
from shroud.operators import redact as R
from shroud.operators import review as RV
from shroud.sources import files as FS


@dataclass(frozen=True)
class WorkflowConfig:
    patterns: tuple = P.DEFAULT
    style: str = "label"
    ttl_minutes: int = 1440
    keyword_path: str = "auto"
    ner: N.ScorerSpec | None = N.LEXICON


def detect_step(files: DataFrame, dictionary: DataFrame, cfg: WorkflowConfig) -> DataFrame:
    """Patterns, dictionary and entities on ``content``, merged."""
    found = D.detect_patterns(files, "content", cfg.patterns)
    found = K.detect_keywords(found, "content", dictionary, key_cols=["file_id"], path=cfg.keyword_path)
    if cfg.ner is not None:
        found = N.detect_ner(found, "content", cfg.ner, out="__ner")
        found = D.union_findings(found, ["findings", "__ner"]).drop("__ner")
    return D.merge(found)


def review_step(detected: DataFrame, decisions: DataFrame | None) -> DataFrame:
    """H2: the latest decisions, as one small array per document, are
    left-joined on the file id and applied on the row (then merged again)."""
    if decisions is None:
        return detected
    dec = decisions.withColumn("doc_id", F.col("doc_id").cast("string"))
    per_doc = RV.decisions_per_doc(dec).withColumnRenamed("doc_id", "file_id")
    joined = detected.join(per_doc, "file_id", "left")
    return joined.withColumn("findings", RV.apply_decisions_array("findings", "decisions")).drop("decisions")


def redact_step(reviewed: DataFrame, style: str) -> DataFrame:
    return R.apply_redactions(reviewed, "content", "findings", style, out="redacted_text", merged=True, stable=True)


def download_step(redacted: DataFrame, requests: DataFrame, keys: DataFrame,
                  ttl_minutes: int) -> tuple[DataFrame, DataFrame]:
    """S5 on the file metadata only; the redacted text is then kept for the
    granted ids by a semi join (the text never meets the request rows)."""
    meta = redacted.select("file_id", "key_id", "created_at", F.lit(None).cast("string").alias("content"),
                           "n_chars")
    granted, refused = FS.download(meta, requests, keys, ttl_minutes)
    out = redacted.join(granted.select("file_id"), "file_id", "left_semi")
    return out, refused


def review_on_row(detected: DataFrame, decide) -> DataFrame:
    """H2 with decisions computed on the document row: ``decide`` returns an
    ``array<struct<start,end,action,entity>>`` column from the row's columns
    (e.g. per-document review flags joined on the file id)."""
    return detected.withColumn("__dec", decide()) \
        .withColumn("findings", RV.apply_decisions_array("findings", "__dec")).drop("__dec")


def run(documents: DataFrame, keys: DataFrame, dictionary: DataFrame, requests: DataFrame,
        tombstones: DataFrame | None = None, decisions: DataFrame | None = None,
        created_at: Column | None = None, cfg: WorkflowConfig = WorkflowConfig(),
        row_info: DataFrame | None = None, decide=None) -> tuple[DataFrame, DataFrame]:
    """The whole workflow; returns (delivered documents, refused downloads).

    Every join is on ``file_id``: once the text side is partitioned by it
    (the first join that needs a shuffle), deletions, per-document review
    information, decisions and the download check reuse that partitioning,
    so the text moves at most once.  ``decisions`` is a decisions table (M11);
    alternatively ``row_info`` (file_id + columns) is joined to the rows and
    ``decide`` turns them into decisions on the row.
    """
    files = FS.ingest_local(documents, keys, created_at)
    if tombstones is not None:
        files = FS.delete_files(files, tombstones)
    if row_info is not None:
        files = files.join(row_info, "file_id", "left")
    detected = detect_step(files, dictionary, cfg)
    reviewed = review_step(detected, decisions)
    if decide is not None:
        reviewed = review_on_row(reviewed, decide)
    redacted = redact_step(reviewed, cfg.style)
    return download_step(redacted, requests, keys, cfg.ttl_minutes)

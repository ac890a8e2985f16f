"""Registered queries: workflow W1 (flagship), stage funnel J12, redaction
requests R3, redaction result R6, saved job JSON S9."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shroud.operators import jobs as J
from shroud.operators import keywords as K
from shroud.operators import protect as PR
from shroud.plans import oracle as O
from shroud.plans import q_files as QF
from shroud.plans import stages as ST
from shroud.plans import workflow as W
from shroud.plans.q_detect import DOC_M
from shroud.plans.q_review import ADDS_SQL, REV_F
from shroud.plans.registry import register
from shroud.session import scratch_path
from shroud.sources import files as FS
from shroud.sources.sinks import save_results_json
from shroud.sources.tables import spread, table
from shroud.operators import detect as D

MISSING_FDF_RULE = "n_chars % 11 = 0"   # derived requests without annotation reference
BAD_PDF_RULE = "n_chars % 13 = 0"       # derived requests with an altered document token

APPLIED_SQL = O.merged(f"SELECT * FROM ({REV_F}) AS m WHERE doc_id NOT IN "
                       f"(SELECT doc_id FROM labels WHERE quality = 0) UNION ALL {ADDS_SQL}", "doc_id")


def _requests(spark, sf_dir, keys):
    fresh = QF._local_files(spark, sf_dir, keys).select("file_id", "dek_token", "n_chars")
    return fresh.select(
        "file_id",
        F.when(F.expr(QF.BAD_TOKEN_RULE), F.concat(F.lit("x"), F.col("dek_token")))
        .otherwise(F.col("dek_token")).alias("dek_token"),
        (F.lit(QF.INGESTED_AT).cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.expr(QF.DELAY_RULE).cast("int"))).alias("requested_at"))


# The reviewers' decisions the workflow applies, derived from ``labels`` on the
# document row: quality 0 -> every finding rejected; toxic 1 -> a note added at
# the start of the text.  (The same rules as the decisions table of the review
# queries; accepting changes nothing, so accepts need no entry here.)
_ROW_DECISIONS = (
    "CASE WHEN quality = 0 THEN transform(findings, f -> named_struct('start', f.start, 'end', f.end, "
    "'action', 'reject', 'entity', CAST(NULL AS STRING))) "
    "WHEN quality = 1 AND toxic = 1 AND n_chars > 0 THEN array(named_struct('start', 0, "
    "'end', CAST(least(10, n_chars) AS INT), 'action', 'add', 'entity', 'review_note')) "
    "ELSE CAST(array() AS array<struct<start:int,end:int,action:string,entity:string>>) END")


def run_workflow(spark, sf_dir):
    keys = PR.load_or_create_keys(spark)
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars"), "doc_id")
    dictionary = K.keyword_dictionary(spark)
    # per-document review flags join on the file id like every other step,
    # so detection runs once and only the small label table moves
    flags = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("file_id"),
                                                  "quality", "toxic")
    return W.run(docs, keys, dictionary, _requests(spark, sf_dir, keys), QF._tombstones(spark, sf_dir),
                 None, F.lit(QF.INGESTED_AT).cast("timestamp"), row_info=flags,
                 decide=lambda: F.expr(_ROW_DECISIONS))


ORACLE_WORKFLOW = (f"SELECT r.doc_id, r.n_redactions, r.redacted_text FROM ({O.redacted('documents', 'doc_id', APPLIED_SQL)}) AS r "
                   f"JOIN ({QF._REQ}) AS g ON CAST(r.doc_id AS VARCHAR) = g.file_id WHERE ({QF._REASON}) IS NULL")


@register("workflow", sql=ORACLE_WORKFLOW)
def workflow(spark, sf_dir):
    delivered, _ = run_workflow(spark, sf_dir)
    return delivered.select(F.col("file_id").cast("bigint").alias("doc_id"),
                            F.size("findings").alias("n_redactions"), "redacted_text")


# ---- R3 / R6 ----
def _redaction_inputs(spark, sf_dir):
    """Stored files (document and annotation, each with its own token) and
    the redaction requests users send for them, all from one ingestion."""
    keys = PR.load_or_create_keys(spark)
    files = FS.with_master(QF._local_files(spark, sf_dir, keys).select("file_id", "dek_token", "key_id", "n_chars"),
                           keys)
    fdf_id = F.concat(F.lit("fdf-"), F.col("file_id"))
    both = files.select("file_id", "dek_token", "n_chars", fdf_id.alias("fdf_id"),
                        FS.wrap_token(F.col("master"), fdf_id).alias("fdf_token_real"))
    pdf = both.select("file_id", "dek_token")
    ann = both.select(F.col("fdf_id").alias("file_id"), F.col("fdf_token_real").alias("dek_token"))
    req = both.select(
        F.col("file_id").cast("bigint").alias("doc_id"), F.col("file_id").alias("pdf_file_id"),
        F.when(F.expr(BAD_PDF_RULE), F.concat(F.lit("x"), F.col("dek_token"))).otherwise(F.col("dek_token"))
        .alias("pdf_token"),
        F.when(~F.expr(MISSING_FDF_RULE), F.col("fdf_id")).alias("fdf_file_id"),
        F.when(~F.expr(MISSING_FDF_RULE), F.col("fdf_token_real")).alias("fdf_token"))
    return J.redaction_requests(req, pdf, ann)


_NCH = "(SELECT doc_id, length(text) AS n_chars FROM documents)"
_RREASON = (f"CASE WHEN {MISSING_FDF_RULE} THEN 'annotation reference missing' "
            f"WHEN {BAD_PDF_RULE} THEN 'document token rejected' END")


@register("redaction_requests",
          sql=(f"SELECT doc_id, CAST(doc_id AS VARCHAR) AS pdf_file_id, 'fdf-' || CAST(doc_id AS VARCHAR) AS fdf_file_id "
               f"FROM {_NCH} AS d WHERE ({_RREASON}) IS NULL"))
def redaction_requests(spark, sf_dir):
    accepted, _, _ = _redaction_inputs(spark, sf_dir)
    return accepted


@register("redaction_refused",
          sql=f"SELECT doc_id, {_RREASON} AS reason FROM {_NCH} AS d WHERE ({_RREASON}) IS NOT NULL")
def redaction_refused(spark, sf_dir):
    _, refused, _ = _redaction_inputs(spark, sf_dir)
    return refused


@register("redaction_result",
          sql=(f"SELECT 'redact-' || CAST(doc_id AS VARCHAR) AS job_id, CASE WHEN ({_RREASON}) IS NULL THEN 'finished' "
               f"ELSE 'error' END AS status, CASE WHEN ({_RREASON}) IS NULL THEN 'red-' || CAST(doc_id AS VARCHAR) END "
               f"AS pdf_file_id FROM {_NCH} AS d"))
def redaction_result(spark, sf_dir):
    _, _, checked = _redaction_inputs(spark, sf_dir)
    return J.redaction_result(checked)


# ---- J12 ----
_FUNNEL_SQL = (
    f"SELECT stage, CAST(n_ok AS BIGINT) AS n_ok, CAST(n_failed AS BIGINT) AS n_failed FROM ("
    f"SELECT 'uploaded' AS stage, count_if(text IS NOT NULL) AS n_ok, count_if(text IS NULL) AS n_failed, 1 AS o FROM documents "
    f"UNION ALL SELECT 'detected', count_if(NOT deleted), count_if(deleted), 2 FROM ({QF._REQ}) AS r "
    f"UNION ALL SELECT 'redacted', count_if(NOT ({MISSING_FDF_RULE} OR {BAD_PDF_RULE})), "
    f"count_if({MISSING_FDF_RULE} OR {BAD_PDF_RULE}), 3 FROM ({QF._REQ}) AS r WHERE NOT deleted "
    f"UNION ALL SELECT 'downloaded', count_if(({QF._REASON}) IS NULL), count_if(({QF._REASON}) IS NOT NULL), 4 "
    f"FROM ({QF._REQ}) AS r WHERE NOT deleted AND NOT ({MISSING_FDF_RULE} OR {BAD_PDF_RULE})) AS t")


def _stage_results(spark, sf_dir):
    """Upload, detection, redaction and download run for real, each on what the one before passed."""
    keys = PR.load_or_create_keys(spark)
    root, cfg = scratch_path(spark, "stage-tables", uuid.uuid4().hex[:12]), W.WorkflowConfig()
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars"), "doc_id")
    files = ST.upload(docs, keys, F.lit(QF.INGESTED_AT).cast("timestamp"), root)
    found = ST.detect(files, QF._tombstones(spark, sf_dir), K.keyword_dictionary(spark), cfg, root)
    _, _, checked = _redaction_inputs(spark, sf_dir)
    redacted = ST.redact(found, checked.select(F.col("pdf_file_id").alias("file_id"), "reason"), cfg, root)
    ST.deliver(redacted, _requests(spark, sf_dir, keys), keys, cfg.ttl_minutes, root)
    return ST.results(spark, root)


@register("stage_funnel", sql=_FUNNEL_SQL)
def stage_funnel(spark, sf_dir):
    """Passed and failed files by stage, counted from the stage tables only."""
    return ST.funnel(_stage_results(spark, sf_dir))


@register("stage_errors", sql=(
    "SELECT stage, error, count(*) AS n_files FROM ("
    "SELECT 'uploaded' AS stage, 'no text' AS error FROM documents WHERE text IS NULL "
    f"UNION ALL SELECT 'detected', 'file not found' FROM ({QF._REQ}) AS r WHERE n_chars IS NOT NULL AND deleted "
    f"UNION ALL SELECT 'redacted', {_RREASON} FROM ({QF._REQ}) AS r WHERE n_chars IS NOT NULL AND NOT deleted "
    f"UNION ALL SELECT 'downloaded', {QF._REASON} FROM ({QF._REQ}) AS r WHERE n_chars IS NOT NULL AND NOT deleted "
    f"AND ({_RREASON}) IS NULL) AS e WHERE error IS NOT NULL GROUP BY stage, error"))
def stage_errors(spark, sf_dir):
    """Files by stage and error."""
    return ST.stage_errors(_stage_results(spark, sf_dir))


# ---- S9 ----
_ITEM = ("'{\"start\":' || start || ',\"end\":' || end_ || ',\"entity\":\"' || entity || "
         "'\",\"detector\":\"' || detector || '\"}'")
_RESULTS_SQL = (
    "SELECT 'detect-' || CAST(d.doc_id AS VARCHAR) AS job_id, '{\"jobId\":\"detect-' || CAST(d.doc_id AS VARCHAR) || "
    "'\",\"jobStatus\":\"finished\",\"outputFiles\":[{\"fileCode\":\"fdf\",\"fileId\":\"fdf-' || CAST(d.doc_id AS VARCHAR) || "
    "'\"}],\"result\":{\"redactions\":' || coalesce(r.js, '[]') || '}}' AS json FROM documents AS d LEFT JOIN ("
    f"SELECT doc_id, '[' || string_agg({_ITEM}, ',' ORDER BY start) || ']' AS js FROM ({DOC_M}) AS m GROUP BY doc_id) AS r "
    "ON d.doc_id = r.doc_id")


@register("results_json", sql=_RESULTS_SQL)
def results_json(spark, sf_dir):
    """Each detection job's response kept as one JSON line, then read back.
    Tokens are left out of the saved record (never stored in clear)."""
    from shroud.plans.q_detect import doc_findings
    merged = D.merge(doc_findings(spark, sf_dir))
    jid = F.concat(F.lit("detect-"), F.col("doc_id").cast("string"))
    reds = F.transform("findings", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                       x["entity"].alias("entity"), x["detector"].alias("detector")))
    body = F.to_json(F.struct(
        jid.alias("jobId"), F.lit("finished").alias("jobStatus"),
        F.array(F.struct(F.lit("fdf").alias("fileCode"),
                         F.concat(F.lit("fdf-"), F.col("doc_id").cast("string")).alias("fileId"))).alias("outputFiles"),
        F.struct(reds.alias("redactions")).alias("result")))
    path = scratch_path(spark, "results-json", uuid.uuid4().hex[:12])
    save_results_json(merged.select(body.alias("json")), path)
    back = spark.read.text(path)
    return back.select(F.get_json_object("value", "$.jobId").alias("job_id"), F.col("value").alias("json"))

"""Registered queries: job records J1-J11, redaction input R1-R3, R6, S9, S10."""

from __future__ import annotations

from pyspark.sql import functions as F

from shroud.operators import jobs as J
from shroud.plans.registry import register
from shroud.session import scratch_path
from shroud.sources import events as EV
from shroud.sources.sinks import load_redactions_json
from shroud.sources.tables import table

AS_OF = "2024-02-01 00:00:00"  # evaluation time for jobs without a terminal event

# ---- SQL: the same event derivation, written for DuckDB ----
_ST = ("CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'finished' "
       "ELSE 'inProgress' END")
EV_SQL = (f"(SELECT event_id, user_id, ts, {_ST} AS status, "
          f"CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)")
_RANKED = (f"(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn_first, "
           f"row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_last FROM {EV_SQL} AS e)")
_TERM = ("(SELECT user_id, ts AS t_ts, event_id AS t_id FROM (SELECT *, row_number() OVER "
         f"(PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {EV_SQL} AS e "
         "WHERE status IN ('finished', 'error')) AS t WHERE rn = 1)")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "props")


def _job_events(spark, sf_dir):
    return EV.job_events(_events(spark, sf_dir))


def _responses(spark, sf_dir):
    return EV.job_responses(_events(spark, sf_dir))


_MODE = "CASE k % 3 WHEN 0 THEN 'sync' WHEN 1 THEN 'async' ELSE 'batch' END"


@register("mode_validation",
          sql=(f"SELECT event_id AS case_id, {_MODE} AS mode, {_MODE} IN ('sync', 'async') AS valid, "
               f"CASE WHEN {_MODE} NOT IN ('sync', 'async') THEN "
               f"'processing mode must be ''sync'' or ''async'': ' || {_MODE} END AS reason FROM {EV_SQL} AS e"))
def mode_validation(spark, sf_dir):
    """Requests carry a processing mode chosen from the event (some invalid)."""
    ev = _events(spark, sf_dir).select(
        F.col("event_id").alias("case_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))
    req = ev.select("case_id", F.when(F.col("k") % 3 == 0, "sync").when(F.col("k") % 3 == 1, "async")
                    .otherwise("batch").alias("mode"))
    return J.mode_validation(req, "mode").select("case_id", "mode", "valid", "reason")


@register("job_latest", sql=f"SELECT user_id AS job_id, status, ts FROM {_RANKED} AS r WHERE rn_last = 1")
def job_latest(spark, sf_dir):
    # event times were read as TIMESTAMP for watermark use; the answer gives
    # them back in the source's type (wall-clock, no zone)
    return J.job_latest(_job_events(spark, sf_dir)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("resolve_response",
          sql=(f"SELECT f.user_id AS job_id, CASE WHEN f.status = 'inProgress' THEN l.status ELSE f.status END "
               f"AS final_status FROM {_RANKED} AS f JOIN {_RANKED} AS l ON f.user_id = l.user_id "
               f"AND f.rn_first = 1 AND l.rn_last = 1"))
def resolve_response(spark, sf_dir):
    return J.resolve_response(_job_events(spark, sf_dir))


@register("job_timeouts",
          sql=(f"SELECT f.user_id AS job_id, "
               f"(epoch_us(coalesce(t.t_ts, TIMESTAMP '{AS_OF}')) - epoch_us(f.ts)) // 1000000 AS seconds, "
               f"(epoch_us(coalesce(t.t_ts, TIMESTAMP '{AS_OF}')) - epoch_us(f.ts)) // 1000000 > {J.JOB_TIMEOUT_S} "
               f"AS timed_out FROM {_RANKED} AS f LEFT JOIN {_TERM} AS t ON f.user_id = t.user_id "
               f"WHERE f.rn_first = 1"))
def job_timeouts(spark, sf_dir):
    return J.job_timeouts(_job_events(spark, sf_dir), F.lit(AS_OF).cast("timestamp"))


@register("poll_stats",
          sql=(f"SELECT e.user_id AS job_id, count(*) AS polls, "
               f"(epoch_us(min(t.t_ts)) - epoch_us(min(e.ts))) // 1000000 AS seconds "
               f"FROM {EV_SQL} AS e JOIN {_TERM} AS t ON e.user_id = t.user_id "
               f"WHERE e.ts < t.t_ts OR (e.ts = t.t_ts AND e.event_id <= t.t_id) GROUP BY e.user_id"))
def poll_stats(spark, sf_dir):
    return J.poll_stats(_job_events(spark, sf_dir))


# per-response facts in SQL
_FDF_ID = ("CASE WHEN status = 'finished' THEN 'fdf-' || CAST(event_id AS VARCHAR) "
           "WHEN status = 'inProgress' AND k % 3 = 0 THEN 'fdf-j' || CAST(user_id AS VARCHAR) END")
_FDF_TOK = ("(status = 'finished' AND k % 2 = 0) OR (status = 'inProgress' AND k % 3 = 0)")
_PDF_ID = "CASE WHEN status = 'finished' THEN 'pdf-' || CAST(event_id AS VARCHAR) END"
_TITLE = ("CASE WHEN status = 'error' AND k % 4 = 0 THEN 'Detection failed' "
          "WHEN status = 'finished' AND k % 9 = 0 THEN 'Partial result' END")
_DETAIL = "CASE WHEN status = 'error' AND k % 4 IN (0, 3) THEN 'code ' || CAST(k AS VARCHAR) END"
_TRACE = "CASE WHEN status = 'error' AND k % 4 = 0 THEN 't' || CAST(event_id AS VARCHAR) END"
_FAILED = "(status = 'error' OR (status = 'finished' AND k % 9 = 0))"


@register("output_file_first",
          sql=f"SELECT event_id AS case_id, {_FDF_ID} AS fdf_file_id, {_PDF_ID} AS pdf_file_id FROM {EV_SQL} AS e")
def output_file_first(spark, sf_dir):
    r = _responses(spark, sf_dir)
    v = J.parsed(F.col("json"))
    return r.select(F.col("event_id").alias("case_id"), J.output_file(v, "fdf")["fileId"].alias("fdf_file_id"),
                    J.output_file(v, "pdf")["fileId"].alias("pdf_file_id"))


@register("token_carry",
          sql=(f"SELECT f.user_id AS job_id, coalesce(f.fdf, CASE WHEN f.status = 'inProgress' THEN l.fdf "
               f"ELSE f.fdf END) AS fdf_file_id, "
               f"CASE WHEN f.fdf IS NOT NULL THEN f.tok WHEN f.status = 'inProgress' THEN coalesce(l.tok AND l.fdf IS NOT NULL, false) "
               f"ELSE false END AS token_present "
               f"FROM (SELECT *, {_FDF_ID} AS fdf, {_FDF_TOK} AS tok FROM {_RANKED} AS r) AS f "
               f"JOIN (SELECT *, {_FDF_ID} AS fdf, {_FDF_TOK} AS tok FROM {_RANKED} AS r) AS l "
               f"ON f.user_id = l.user_id AND f.rn_first = 1 AND l.rn_last = 1"))
def token_carry(spark, sf_dir):
    """The reference and token come from the first answer, else from the
    final one -- the whole struct, so a token never pairs with another file."""
    return J.token_carry(_responses(spark, sf_dir))


@register("job_failed", sql=f"SELECT event_id AS case_id, {_FAILED} AS failed FROM {EV_SQL} AS e")
def job_failed(spark, sf_dir):
    r = _responses(spark, sf_dir)
    return r.select(F.col("event_id").alias("case_id"), J.job_failed(J.parsed(F.col("json"))).alias("failed"))


@register("error_message",
          sql=(f"SELECT event_id AS case_id, concat_ws(' ', coalesce(nullif({_TITLE}, ''), 'Detection job failed.'), "
               f"CASE WHEN {_DETAIL} <> '' THEN 'Detail: ' || {_DETAIL} END, "
               f"CASE WHEN {_TRACE} <> '' THEN 'TraceId: ' || {_TRACE} END) AS message "
               f"FROM {EV_SQL} AS e WHERE {_FAILED}"))
def error_message(spark, sf_dir):
    r = _responses(spark, sf_dir)
    v = J.parsed(F.col("json"))
    return r.where(J.job_failed(v)).select(F.col("event_id").alias("case_id"),
                                           J.error_message(v, "Detection").alias("message"))


@register("job_summary",
          sql=(f"SELECT event_id AS case_id, CAST(user_id AS VARCHAR) AS job_id, status, {_TITLE} AS error_title, "
               f"{_DETAIL} AS error_detail, {_TRACE} AS error_trace_id, {_FDF_ID} AS fdf_file_id, "
               f"{_PDF_ID} AS pdf_file_id, coalesce({_FDF_TOK}, false) AS token_present, "
               f"CASE WHEN status = 'finished' THEN CAST(k % 5 AS INTEGER) END AS n_redactions FROM {EV_SQL} AS e"))
def job_summary(spark, sf_dir):
    return J.job_summary(_responses(spark, sf_dir))


@register("outcome_class",
          sql=(f"SELECT event_id AS case_id, CASE WHEN status = 'inProgress' THEN "
               f"CASE WHEN k % 10 = 0 THEN 'unexpected' ELSE 'inProgress' END "
               f"WHEN {_FAILED} THEN 'failed' ELSE 'finished' END AS outcome FROM {EV_SQL} AS e"))
def outcome_class(spark, sf_dir):
    r = _responses(spark, sf_dir)
    return r.select(F.col("event_id").alias("case_id"),
                    J.outcome_class(F.col("http"), J.parsed(F.col("json"))).alias("outcome"))


_ARR_N = "CASE WHEN status = 'finished' THEN k % 5 ELSE 0 END"
_NORM_SQL = (f"SELECT event_id AS case_id, CAST(CASE WHEN k % 6 = 0 THEN CASE WHEN status = 'finished' THEN k % 5 END "
             f"WHEN k % 6 IN (1, 2, 3) THEN {_ARR_N} END AS INTEGER) AS n, "
             f"CASE WHEN k % 6 = 0 THEN status <> 'finished' ELSE k % 6 IN (4, 5) END AS is_error FROM {EV_SQL} AS e")


@register("normalize_redactions", sql=_NORM_SQL)
def normalize_redactions(spark, sf_dir):
    return J.normalize_redactions(EV.saved_redactions(_responses(spark, sf_dir))).drop("redactions")


@register("redaction_gate",
          sql=(f"SELECT event_id AS case_id, CAST(CASE WHEN status = 'finished' THEN k % 5 END AS INTEGER) AS n, "
               f"status <> 'finished' AS is_error FROM {EV_SQL} AS e"))
def redaction_gate(spark, sf_dir):
    return J.redaction_gate(_responses(spark, sf_dir))


@register("load_redactions", sql=_NORM_SQL)
def load_redactions(spark, sf_dir):
    """The saved files are written as text, read back whole, then R1."""
    import uuid
    saved = EV.saved_redactions(_responses(spark, sf_dir))
    path = scratch_path(spark, "saved-redactions", uuid.uuid4().hex[:12])
    lines = saved.select(F.to_json(F.struct(F.col("case_id"), F.col("json").alias("doc"))).alias("value"))
    lines.write.mode("errorifexists").text(path)
    back = load_redactions_json(spark, path, wholetext=False)
    rows = back.select(F.get_json_object("json", "$.case_id").cast("bigint").alias("case_id"),
                       F.get_json_object("json", "$.doc").alias("json"))
    return J.normalize_redactions(rows).drop("redactions")


@register("poll_percentiles")
def poll_percentiles(spark, sf_dir):
    """J11 summary, rows-only: approximate quantiles have no exact SQL twin."""
    stats = J.poll_stats(_job_events(spark, sf_dir))
    return J.poll_percentiles(stats).select(
        F.get("polls_p50_p90", 0).alias("polls_p50"), F.get("polls_p50_p90", 1).alias("polls_p90"),
        F.get("seconds_p50_p90", 0).alias("seconds_p50"), F.get("seconds_p50_p90", 1).alias("seconds_p90"))


_STATS_SQL = ("SELECT count(*) AS polls, (epoch_us(min(t.t_ts)) - epoch_us(min(e.ts))) // 1000000 AS seconds "
              f"FROM {EV_SQL} AS e JOIN {_TERM} AS t ON e.user_id = t.user_id "
              "WHERE e.ts < t.t_ts OR (e.ts = t.t_ts AND e.event_id <= t.t_id) GROUP BY e.user_id")


@register("poll_quantiles", sql=(
    f"SELECT m.measure, q.q, s.n, true AS within FROM (SELECT count(*) AS n FROM ({_STATS_SQL}) AS x) AS s, "
    "(VALUES ('polls'), ('seconds')) AS m(measure), (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.9 AS DOUBLE)), (CAST(0.99 AS DOUBLE))) AS q(q) WHERE s.n > 0"))
def poll_quantiles(spark, sf_dir):
    """J11 summary from stored hourly sketches, with the exact rank of every value checked against the bound."""
    import uuid
    events = _job_events(spark, sf_dir)
    path = scratch_path(spark, "poll-sketches", uuid.uuid4().hex[:12])
    J.poll_sketches(events).write.parquet(path)
    return J.rank_check(J.poll_stats(events), J.sketch_quantiles(spark.read.parquet(path)))


# derived requests: the kind by the event's type, answered after a time that follows from ``k``, some never
_KIND = "CASE event_type WHEN 'signup' THEN 'upload' WHEN 'view' THEN 'poll' WHEN 'purchase' THEN 'download' WHEN 'click' THEN 'sync' ELSE 'async' END"


@register("request_timeouts", sql=(
    "SELECT event_id AS case_id, kind, seconds, limit_s, seconds > limit_s AS timed_out FROM ("
    f"SELECT event_id, kind, CASE WHEN k % 9 = 0 THEN (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) // 1000000 ELSE k * 45 END AS seconds, "
    f"CAST(CASE WHEN kind = 'sync' THEN {J.JOB_TIMEOUT_S} ELSE {J.PLAIN_TIMEOUT_S} END AS INTEGER) AS limit_s "
    f"FROM (SELECT event_id, ts, {_KIND} AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) AS e) AS r"))
def request_timeouts(spark, sf_dir):
    """120 s for plain requests, 3600 s for one that waits for its job."""
    k = F.get_json_object("props", "$.k").cast("int")
    req = _events(spark, sf_dir).select(
        F.col("event_id").alias("case_id"), F.expr(_KIND).alias("kind"), F.col("ts").cast("timestamp").alias("started"),
        F.when(k % 9 != 0, F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k * 45).cast("decimal(18,6)"))).alias("ended"))
    return J.request_timeouts(req, F.lit(AS_OF).cast("timestamp"))

"""Registered queries: streaming T1-T4 (run with ``availableNow``, read back)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shroud.operators.protect import latest_issue
from shroud.plans.q_detect import DOC_M
from shroud.plans.registry import ORACLE, register
from shroud.sources.events import job_events
from shroud.session import scratch_path
from shroud.streaming import operators as S
from shroud.streaming import stateful as ST
from shroud.streaming.answers import job_states, run_two_phase
from shroud.streaming.runner import run_available, stream_table


@register("stream_detect", sql=f"SELECT doc_id, start, end_, entity, detector FROM ({DOC_M}) AS m")
def stream_detect(spark, sf_dir):
    # stateless and narrow: the splits of the source's files set the tasks, no text is shuffled
    docs = stream_table(spark, sf_dir, "documents").select("doc_id", "text")
    return run_available(S.detect_stream(docs), "detect")


@register("stream_dedup", sql="SELECT event_id FROM events")
def stream_dedup(spark, sf_dir):
    """Every click and view request is delivered a second time two minutes
    later (a second source on the same file); the copies are dropped."""
    first = stream_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    again = (stream_table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
             .select("event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 2 MINUTES")).alias("ts")))
    out = S.dedup_stream(first.unionByName(again), "event_id", "ts")
    return run_available(out.select("event_id"), "dedup")


def _token_sql():
    from shroud.plans.q_files import token_valid_uses  # noqa: F401  (registers the batch twin)
    return ORACLE["token_valid_uses"]


@register("stream_token_uses", sql=_token_sql())
def stream_token_uses(spark, sf_dir):
    ev = stream_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    issues = ev.where(F.col("event_type") == "signup")
    uses = ev.where(F.col("event_type") == "purchase")
    return latest_issue(run_available(S.token_uses_stream(issues, uses, 1440), "token_uses"))


def _tracker_sql():
    from shroud.plans.q_jobs import EV_SQL
    deadline = f"INTERVAL {S.JOB_DEADLINE_S} SECOND"
    return (f"SELECT f.user_id AS job_id, coalesce(t.status, 'timeout') AS status, "
            f"coalesce(t.ts, f.t0 + {deadline}) AS ts FROM "
            f"(SELECT user_id, min(ts) AS t0 FROM {EV_SQL} AS e GROUP BY user_id) AS f LEFT JOIN "
            f"(SELECT e.user_id, e.ts, e.status, row_number() OVER (PARTITION BY e.user_id "
            f"ORDER BY e.ts, e.event_id) AS rn FROM {EV_SQL} AS e JOIN "
            f"(SELECT user_id, min(ts) AS t0 FROM {EV_SQL} AS e0 GROUP BY user_id) AS g ON e.user_id = g.user_id "
            f"WHERE e.status IN ('finished', 'error') AND e.ts <= g.t0 + {deadline}) AS t "
            f"ON f.user_id = t.user_id AND t.rn = 1")


@register("stream_job_tracker", sql=_tracker_sql())
def stream_job_tracker(spark, sf_dir):
    """The outcome per job, from the streaming minima per job and window."""
    ev = stream_table(spark, sf_dir, "events")
    partials = run_available(S.job_tracker_stream(job_events(ev)), "job_tracker", output_mode="update")
    return S.job_outcomes(partials).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_answers", sql=(
    "SELECT 'detect-' || CAST(d.doc_id AS VARCHAR) AS job_id, 'inProgress' AS first_status, 'fdf-' || CAST(d.doc_id AS VARCHAR) "
    "AS fdf_file_id, CASE WHEN d.text IS NULL THEN 'error' ELSE 'finished' END AS status, "
    "CASE WHEN d.text IS NOT NULL THEN CAST(coalesce(m.n, 0) AS INTEGER) END AS n_redactions, "
    "CASE WHEN d.text IS NULL THEN 'no text' END AS error FROM documents AS d LEFT JOIN "
    f"(SELECT doc_id, count(*) AS n FROM ({DOC_M}) AS f GROUP BY doc_id) AS m ON d.doc_id = m.doc_id"))
def stream_answers(spark, sf_dir):
    """T1 with J3 and J5: accepted with a reference first, answered in a second write."""
    docs = stream_table(spark, sf_dir, "documents").select("doc_id", "text")
    root = scratch_path(spark, "streams", "answers", uuid.uuid4().hex[:12])
    run_two_phase(docs, f"{root}/out", f"{root}/checkpoint")
    return job_states(spark, f"{root}/out")


@register("stream_job_outcomes", sql=(
    f"SELECT job_id, status, ts FROM ({_tracker_sql()}) AS o "
    "WHERE ts <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE"))
def stream_job_outcomes(spark, sf_dir):
    """Outcomes, timeouts included, as the stream itself gives them: those the final watermark has passed."""
    ev = stream_table(spark, sf_dir, "events")
    out = run_available(ST.job_outcome_stream(job_events(ev), S.JOB_DEADLINE_S), "job_outcomes", rocksdb=True)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_token_answers", sql=_token_sql())
def stream_token_answers(spark, sf_dir):
    """T3 from expiring state: the sink holds a row per answered use, no pairs."""
    ev = stream_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    issues = ev.where(F.col("event_type") == "signup")
    uses = ev.where(F.col("event_type") == "purchase")
    return latest_issue(run_available(ST.token_answers_stream(issues, uses, 1440), "token_answers", "update", rocksdb=True))

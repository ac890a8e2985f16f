"""J12 stage tables on a small case, J11 sketches and hot jobs, D8 responses."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shroud.operators import detect as D
from shroud.operators import jobs as J
from shroud.operators import keywords as K
from shroud.operators import protect as PR
from shroud.plans import stages as ST
from shroud.plans import workflow as W

AT = "2024-01-01 00:00:00"


def test_stage_tables(spark, tmp_path):
    keys, root, cfg = PR.load_or_create_keys(spark), str(tmp_path / "run"), W.WorkflowConfig()
    docs = spark.createDataFrame([(1, "mail a@b.example", "s"), (2, None, "s"), (3, "", "s"), (4, "gone", "s"), (5, "plain", "s"),
                                  (6, "late", "s")], "doc_id long, text string, source string")
    made = F.lit(AT).cast("timestamp")
    files = ST.upload(docs, keys, made, root)
    assert {r.stage for r in ST.results(spark, root).collect()} == {"uploaded"}  # later stages haven't run
    found = ST.detect(files, spark.createDataFrame([("4",), ("4",)], "file_id string"), K.keyword_dictionary(spark), cfg, root)
    checked = spark.createDataFrame([("1", None), ("3", "document token rejected"), ("6", None), ("9", None)], "file_id string, reason string")
    redacted = ST.redact(found, checked, cfg, root)
    tokens = files.select("file_id", "dek_token")
    ask = tokens.where("file_id IN ('1', '6', '3')").withColumn(
        "requested_at", F.when(F.col("file_id") == "6", F.lit("2024-03-01").cast("timestamp")).otherwise(made))
    ask = ask.unionByName(ask.where("file_id = '1'").withColumn("dek_token", F.lit("x")))  # a second, refused request
    out = ST.deliver(redacted, ask, keys, cfg.ttl_minutes, root)
    assert [(r.file_id, r.redacted_text) for r in out.collect()] == [("1", "mail [EMAIL]")]
    rows = ST.results(spark, root)
    errors = {(r.stage, r.file_id): r.error for r in rows.where("error IS NOT NULL").collect()}
    assert errors == {("uploaded", "2"): "no text", ("detected", "4"): "file not found", ("redacted", "3"): "document token rejected",
                      ("redacted", "5"): "no request", ("downloaded", "6"): "expired"}
    counts = {r.stage: (r.n_ok, r.n_failed) for r in ST.funnel(rows).collect()}
    assert counts == {"uploaded": (5, 1), "detected": (4, 1), "redacted": (2, 2), "downloaded": (1, 1)}
    empty = ST.funnel(ST.results(spark, str(tmp_path / "none"))).collect()
    assert {(r.n_ok, r.n_failed) for r in empty} == {(0, 0)} and len(empty) == 4


def _events(spark, n_jobs):
    start = datetime(2024, 1, 1)
    rows, n = [], 0
    for j in range(n_jobs):
        polls = 400 if j == 0 else j % 17 + 1  # job 0 is hot
        for p in range(polls):
            rows.append((n, j, start + timedelta(minutes=7 * j, seconds=p * (j % 5 + 1)), "finished" if p == polls - 1 else "inProgress"))
            n += 1
        rows.append((n, j, start + timedelta(days=9, seconds=j), "error"))  # after the outcome
        n += 1
    rows.append((n, n_jobs, start, "inProgress"))  # no outcome
    return rows, spark.createDataFrame(rows, "event_id long, job_id long, ts timestamp, status string")


def test_poll_counts_of_a_hot_job(spark):
    rows, events = _events(spark, 60)
    got = {r.job_id: (r.polls, r.seconds) for r in J.poll_stats(events).collect()}
    assert got == {j: ((400 if j == 0 else j % 17 + 1), ((400 if j == 0 else j % 17 + 1) - 1) * (j % 5 + 1)) for j in range(60)}


def test_hourly_sketches_merge_within_the_bound(spark):
    _, events = _events(spark, 300)
    sketches = J.poll_sketches(events)
    assert sketches.count() > 20 and sketches.agg(F.sum("jobs")).first()[0] == 300
    checked = J.rank_check(J.poll_stats(events), J.sketch_quantiles(sketches)).collect()
    assert len(checked) == 6 and all(r.within and r.n == 300 for r in checked)
    wrong = spark.createDataFrame([("polls", 0.5, 300, 10**6)], "measure string, q double, n long, value long")
    assert [r.within for r in J.rank_check(J.poll_stats(events), wrong).collect()] == [False]
    none = events.where("status = 'none'")
    assert J.rank_check(J.poll_stats(none), J.sketch_quantiles(J.poll_sketches(none))).count() == 0


def test_detection_response(spark):
    docs = spark.createDataFrame([(1, "mail a@b.example"), (2, None), (3, "")], "doc_id long, text string")
    rows = {r.job_id: r for r in D.detection_response(D.merge(D.detect_patterns(docs, "text")), "doc_id").collect()}
    assert (rows["detect-1"].status, rows["detect-1"].n_redactions, rows["detect-1"].output_files[0].fileId) == ("finished", 1, "fdf-1")
    assert (rows["detect-2"].status, rows["detect-2"].output_files, rows["detect-2"].redactions_json, rows["detect-2"].error) == ("error", [], None, "no text")
    assert (rows["detect-3"].status, rows["detect-3"].n_redactions, rows["detect-3"].redactions_json) == ("finished", 0, "[]")


def test_request_timeouts(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, "poll", t, t + timedelta(seconds=120)), (2, "poll", t, t + timedelta(seconds=121)), (3, "sync", t, t + timedelta(seconds=3600)),
            (4, "sync", t, None), (5, None, t, t + timedelta(seconds=200)), (6, "poll", None, t)]
    df = spark.createDataFrame(rows, "case_id long, kind string, started timestamp, ended timestamp")
    got = {r.case_id: (r.limit_s, r.timed_out) for r in J.request_timeouts(df, F.lit("2024-01-01 02:00:00").cast("timestamp")).collect()}
    assert got == {1: (120, False), 2: (120, True), 3: (3600, False), 4: (3600, True), 5: (120, True), 6: (120, None)}

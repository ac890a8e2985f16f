"""T1 in two writes, T2 and T3 as keyed state: equal to batch over many files, restart between two writes."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shroud.streaming import operators as S
from shroud.streaming import stateful as ST
from shroud.streaming.answers import job_states, run_two_phase
from shroud.streaming.runner import ROCKSDB, STATE_STORE, run_available

EVENTS = "event_id long, job_id long, ts timestamp, status string"
TOKENS = "event_id long, user_id long, ts timestamp, event_type string"


def _files(spark, tmp_path, ddl, keys, kinds, files=20):
    """Events in ``files`` files, some late, with jumps of days; returns all rows and the stream."""
    rnd, rows = random.Random(4), []
    for f in range(files):
        base = datetime(2024, 1, 1) + timedelta(minutes=20 * f, days=3 * (f > 10) + 30 * (f > 15))
        batch = [(1000 * f + i, rnd.choice(keys), base + timedelta(seconds=rnd.randint(0, 600)) - timedelta(
            minutes=rnd.choice([0, 0, 5, 9])), rnd.choice(kinds)) for i in range(15)]
        rows += batch
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return rows, spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_job_outcomes_with_timeouts_leave_the_stream(spark, tmp_path):
    rows, src = _files(spark, tmp_path, EVENTS, list(range(40)), ["inProgress"] * 6 + ["finished", "error"])
    got = run_available(ST.job_outcome_stream(src, S.JOB_DEADLINE_S), "outcomes", rocksdb=True).collect()
    mark = max(r[2] for r in rows) - timedelta(minutes=10)
    want = [r for r in S.job_tracker_batch(spark.createDataFrame(rows, EVENTS)).collect() if r.ts <= mark]
    key = lambda r: (r.job_id, r.status, r.ts)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert {r.status for r in got} == {"finished", "error", "timeout"}


def test_job_outcomes_ignore_events_without_job(spark, tmp_path):
    rows = [(1, None, datetime(2024, 1, 1), "finished"), (2, 5, None, "finished"), (3, 5, datetime(2024, 1, 1), "finished"),
            (4, 5, datetime(2024, 1, 1), "error"), (5, 6, datetime(2024, 1, 2), "inProgress")]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
    got = run_available(ST.job_outcome_stream(src, 60), "outcomes", rocksdb=True).collect()
    assert [(r.job_id, r.status) for r in got] == [(5, "finished")]  # job 6 is open, ties go to the smaller event


def test_token_answers_one_row_per_use(spark, tmp_path):
    rows, src = _files(spark, tmp_path, TOKENS, [1, 1, 1, 2, 3, None], ["signup", "purchase", "purchase"])
    pick = lambda df, kind: df.where(F.col("event_type") == kind)
    sink = run_available(ST.token_answers_stream(pick(src, "signup"), pick(src, "purchase"), 60), "answers", "update", rocksdb=True)
    uses = [r for r in rows if r[1] is not None and r[3] == "purchase"]
    issues = [r for r in rows if r[1] is not None and r[3] == "signup"]
    want = set()
    for u in uses:
        live = [(i[2], i[0]) for i in issues if i[1] == u[1] and timedelta(0) <= u[2] - i[2] <= timedelta(hours=1)]
        if live:
            want.add((max(live)[1], u[0], u[1]))
    from shroud.operators.protect import latest_issue
    got = latest_issue(sink).collect()
    assert {(r.issue_id, r.use_id, r.user_id) for r in got} == want and len(got) == len(want)
    assert len(want) <= sink.count() <= len(uses) + 40  # answers and corrections by late issues, no pairs


def test_restart_between_the_two_writes(spark, tmp_path):
    for n in range(3):
        spark.createDataFrame([(n, f"mail a{n}@b.example"), (n + 10, None), (n + 20, "")], "doc_id long, text string") \
            .coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def killed(epoch):
        if epoch == 1:
            raise RuntimeError("killed")
    with pytest.raises(Exception, match="killed"):
        run_two_phase(src, out, ckpt, after_accept=killed)
    states = job_states(spark, out).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in states} == {"finished": 2, "error": 1, "inProgress": 3}
    run_two_phase(src, out, ckpt)
    rows = {r.job_id: r for r in job_states(spark, out).collect()}
    assert job_states(spark, out).count() == len(rows) == 9
    assert spark.read.parquet(f"{out}/accepted").count() == spark.read.parquet(f"{out}/answers").count() == 9
    assert all(r.first_status == "inProgress" and r.fdf_file_id for r in rows.values())
    assert (rows["detect-0"].status, rows["detect-0"].n_redactions) == ("finished", 1)
    assert (rows["detect-10"].status, rows["detect-10"].error) == ("error", "no text")
    assert (rows["detect-20"].status, rows["detect-20"].n_redactions) == ("finished", 0)


def test_token_states_are_per_group_and_bucket(spark, tmp_path):
    rows = [(n, n % 200, datetime(2024, 1, 1, 0, 30) + timedelta(seconds=n), "signup" if n < 200 else "purchase") for n in range(400)]
    rows += [(None, 7, datetime(2024, 1, 1, 0, 58), "signup"), (900, 7, datetime(2024, 1, 1, 0, 59), "purchase")]
    spark.createDataFrame(rows, TOKENS).coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(TOKENS).parquet(str(tmp_path / "in"))
    pick = lambda kind: src.where(F.col("event_type") == kind)
    former = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        q = ST.token_answers_stream(pick("signup"), pick("purchase"), 60, groups=4).writeStream.outputMode("update") \
            .format("memory").queryName("token_groups").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, former)
    got = {(r.issue_id, r.use_id, r.user_id) for r in spark.table("token_groups").collect()}
    assert got == {(n - 200, n, n - 200) for n in range(200, 400)} | {(None, 900, 7)}
    # 4 groups in some 7 buckets, with their timers; a state per user had 200 times 5
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 4 * 7 * 3


def test_answers_of_a_group_equal_brute_force():
    rnd = random.Random(9)
    for _ in range(100):
        t = pd.DataFrame([(rnd.choice("ab"), rnd.randint(0, 30), n, rnd.random() < 0.5, ST.NO_ID, True) for n in range(rnd.randint(1, 25))], columns=ST.ROW)
        out, kept = ST._answer(t, 10, 12)
        rows = list(t.itertuples(index=False))
        want = set()
        for u in (r for r in rows if r.is_use):
            live = [(i.us, i.event_id) for i in rows if not i.is_use and i.user_id == u.user_id and i.us <= u.us]
            if live and u.us - max(live)[0] <= 10:
                want.add((max(live)[1], u.event_id))
        assert set(zip(out["issue_id"], out["use_id"], strict=True)) == want
        late = {}
        for i in sorted((r for r in rows if not r.is_use and r.us <= 12), key=lambda r: (r.us, r.event_id)):
            late[i.user_id] = i.event_id
        assert set(kept["event_id"]) == set(late.values()) | {r.event_id for r in rows if r.us > 12}
        assert ST._answer(kept, 10, 12)[0].empty  # nothing twice

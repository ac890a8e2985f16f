"""Plan shape (no shuffle, no Python, pruned scans), protection, streams, entry."""

from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.operators import protect as PR
from shroud.operators import redact as R
from shroud.sources import files as FS
from shroud.sources.events import job_events
from shroud.sources.tables import table
from tests.conftest import SF_MID, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_detect_and_redact_are_narrow(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    out = R.apply_redactions(D.detect_patterns(docs, "text", P.DEFAULT), "text")
    plan = _plan(out)
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_list_files_never_reads_text(spark):
    keys = PR.load_or_create_keys(spark)
    docs = table(spark, SF_SMALL, "documents")
    meta = FS.list_files(FS.ingest_local(docs, keys))
    read_schema = [ln for ln in _plan(meta).split("\n") if "ReadSchema" in ln or "FileScan" in ln]
    assert read_schema and all("text" not in ln.split("ReadSchema")[-1] for ln in read_schema)


def test_protect_roundtrip_and_refusals(spark):
    keys = PR.load_or_create_keys(spark)
    docs = spark.createDataFrame([(1, "secret text é", "s")], "doc_id long, text string, source string")
    files = FS.ingest_local(docs, keys)
    prot = PR.protect(files, keys)
    assert "content" not in prot.columns
    ok = PR.unprotect(prot, files.select("file_id", "dek_token"), keys).collect()[0]
    assert ok.content == "secret text é" and ok.reason is None
    bad = PR.unprotect(prot, files.select("file_id", F.lit("AAAA").alias("dek_token")), keys).collect()[0]
    assert bad.content is None and bad.reason == "bad token"
    moved = prot.withColumn("file_id", F.lit("2"))
    tok2 = FS.with_master(moved.select("file_id", "key_id"), keys).select(
        "file_id", FS.wrap_token(F.col("master"), F.col("file_id")).alias("dek_token"))
    mv = PR.unprotect(moved, tok2, keys).collect()[0]
    assert mv.content is None and mv.reason == "moved content"


def test_keys_never_in_plan(spark):
    keys = PR.load_or_create_keys(spark)
    master = keys.collect()[0].master.hex()
    docs = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    plan = FS.ingest_local(docs, keys)._jdf.queryExecution().toString()
    assert master not in plan.lower()


def test_stream_tracker_equals_batch(spark):
    from shroud.streaming import operators as S
    from shroud.streaming.runner import run_available, stream_table
    partials = run_available(S.job_tracker_stream(job_events(stream_table(spark, SF_MID, "events"))), "t2test", output_mode="update")
    batch = S.job_tracker_batch(job_events(table(spark, SF_MID, "events")))
    got = sorted((r.job_id, r.status, r.ts) for r in S.job_outcomes(partials).collect())
    assert got and got == sorted((r.job_id, r.status, r.ts) for r in batch.collect())


def test_stream_tracker_over_many_files(spark, tmp_path):
    """Late events, events after the outcome and a watermark that jumps by days, over 24 micro-batches."""
    import random
    from datetime import datetime, timedelta

    from shroud.streaming import operators as S
    from shroud.streaming.runner import run_available
    rnd = random.Random(9)
    start = datetime(2024, 1, 1)
    rows, n = [], 0
    for f in range(24):
        base = start + timedelta(minutes=20 * f, days=3 * (f > 12) + 30 * (f > 18))
        batch = []
        for _ in range(12):
            late = timedelta(minutes=rnd.choice([0, 0, 0, 5, 9]))
            batch.append((n, rnd.randint(1, 30), base + timedelta(seconds=rnd.randint(0, 600)) - late,
                          rnd.choice(["inProgress", "inProgress", "finished", "error"])))
            n += 1
        batch.append((n, 1, base, "inProgress"))  # a job that never rests
        n += 1
        rows += batch
        spark.createDataFrame(batch, "event_id long, job_id long, ts timestamp, status string").coalesce(1) \
            .write.mode("append").parquet(str(tmp_path / "ev"))
    schema = "event_id long, job_id long, ts timestamp, status string"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ev"))
    got = S.job_outcomes(run_available(S.job_tracker_stream(src), "t2files", output_mode="update")).collect()
    want = S.job_tracker_batch(spark.createDataFrame(rows, schema)).collect()
    key = lambda r: (r.job_id, r.status, r.ts)
    assert sorted(map(key, got)) == sorted(map(key, want)) and len({r.job_id for r in got}) == len(got)
    plan = S.job_tracker_stream(src)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_stream_detect_equals_batch(spark):
    from shroud.streaming import operators as S
    from shroud.streaming.runner import run_available, stream_table
    s = run_available(S.detect_stream(stream_table(spark, SF_SMALL, "documents").select("doc_id", "text")), "t1test")
    b = S.detect_stream(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.collect()))


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["doc_id", "n_redactions", "redacted_text"]
    assert df.count() >= 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from shroud.plans.registry import QUERIES  # without the optional corpus queries
    assert set(QUERIES) - set(sql) == {"poll_percentiles"}


def test_ingest_text_files_and_write_redacted(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "report.v2.txt").write_text("mail me: a@b.example\nsecond line")
    (src / "notes").write_text("nothing here")
    keys = PR.load_or_create_keys(spark)
    files = FS.ingest_text_files(spark, str(src), keys)
    rows = {r.name: r for r in files.collect()}
    assert set(rows) == {"report.v2.txt", "notes"}
    assert rows["report.v2.txt"].content.endswith("second line") and rows["notes"].n_chars == 12
    red = R.apply_redactions(D.detect_patterns(files, "content"), "content")
    from shroud.sources.sinks import write_redacted
    out = str(tmp_path / "out")
    write_redacted(red, out)
    back = {r.redacted_name: r.redacted_text for r in spark.read.parquet(out).collect()}
    assert back == {"report.v2_redacted.txt": "mail me: [EMAIL]\nsecond line", "notes_redacted": "nothing here"}


def test_no_cross_joins_and_partial_aggregation(spark):
    """No registered query plans a cross join; per-job state is combined map-side."""
    from shroud.plans.registry import QUERIES, load_all
    load_all()
    qs = dict(QUERIES)
    skip = {n for n in qs if n.startswith("stream_")} | {"annotations", "results_json", "load_redactions"}
    for name, fn in qs.items():
        if name in skip:
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
    latest = qs["job_latest"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in latest
    tokens = qs["token_valid_uses"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in tokens  # the interval join runs on (user, time bucket), not on the user alone


def test_spread_leaves_large_inputs_alone(spark, monkeypatch):
    from shroud.sources import tables as T
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    assert "Exchange" in _plan(T.spread(docs, "doc_id"))
    monkeypatch.setattr(T, "SPREAD_MAX_BYTES", 1)
    assert "Exchange" not in _plan(T.spread(docs, "doc_id"))


def test_package_shipped_to_workers(spark):
    """Python steps need ``shroud`` importable in executor workers."""
    import zipfile
    from shroud.session import ship_package
    ship_package(spark)
    zips = [p for p in spark.sparkContext._python_includes if "shroud-" in p]
    assert zips
    from pyspark import SparkFiles
    names = zipfile.ZipFile(SparkFiles.get(zips[0])).namelist()
    assert "shroud/operators/ner.py" in names and "shroud/streaming/operators.py" in names

"""Job-contract cases written down as literal JSON (FIXTURES section 1)."""

import pytest
from pyspark.sql import functions as F

from shroud.operators import jobs as J

R1_CASES = [
    ('{"result":{"redactions":[1]}}', 1, False),
    ('{"redactions":[1,2]}', 2, False),
    ('[1]', 1, False),
    ('[]', 0, False),
    ('{"result":{"redactions":[]}}', 0, False),
    ('{"x":1}', None, True),
    ('{"result":null,"redactions":[]}', 0, False),
    ('{"result":{"redactions":"s"},"redactions":[1]}', None, True),
    ('{"result":{"redactions":null},"redactions":[1]}', 1, False),
    ('"s"', None, True),
    ('null', None, True),
    ('{"redactions":', None, True),
]


def test_normalize_redactions(spark):
    df = spark.createDataFrame([(i, j) for i, (j, _, _) in enumerate(R1_CASES)], "case_id long, json string")
    got = {r.case_id: (r.n, r.is_error) for r in J.normalize_redactions(df).collect()}
    for i, (_, n, err) in enumerate(R1_CASES):
        assert got[i] == (n, err), R1_CASES[i]


RESPONSES = {
    "finished_error_title": ('{"jobStatus":"finished","error":{"title":"x"}}', True),
    "finished_error_empty": ('{"jobStatus":"finished","error":{}}', False),
    "finished_error_code": ('{"jobStatus":"finished","error":{"code":1}}', True),
    "status_error": ('{"jobStatus":"error"}', True),
    "null_status": ('{"jobStatus":null}', False),
    "error_null": ('{"jobStatus":"finished","error":null}', False),
    "plain": ('{"jobStatus":"finished"}', False),
}


def _resp(spark, items):
    return spark.createDataFrame([(i, k, j) for i, (k, j) in enumerate(items)], "event_id long, name string, json string")


def test_job_failed(spark):
    df = _resp(spark, [(k, v[0]) for k, v in RESPONSES.items()])
    got = {r.name: r.f for r in df.select("name", J.job_failed(J.parsed(F.col("json"))).alias("f")).collect()}
    assert got == {k: v[1] for k, v in RESPONSES.items()}


def test_error_message(spark):
    df = _resp(spark, [("full", '{"jobStatus":"error","error":{"title":"T","detail":"D","traceId":"X"}}'),
                       ("bare", '{"jobStatus":"error"}'),
                       ("detail", '{"jobStatus":"error","error":{"title":"","detail":"D"}}')])
    got = {r.name: r.m for r in df.select("name", J.error_message(J.parsed(F.col("json")), "Detection").alias("m")).collect()}
    assert got == {"full": "T Detail: D TraceId: X", "bare": "Detection job failed.",
                   "detail": "Detection job failed. Detail: D"}


def test_output_files_and_shell_rule(spark):
    df = _resp(spark, [("null", '{"outputFiles":null}'),
                       ("two", '{"outputFiles":[{"fileCode":"fdf","fileId":"a"},{"fileCode":"fdf","fileId":"b"}]}'),
                       ("code", '{"jobStatus":"finished","error":{"code":1}}')])
    v = J.parsed(F.col("json"))
    got = {r.name: (r.fid, r.shell) for r in df.select(
        "name", J.output_file(v, "fdf")["fileId"].alias("fid"), J.shell_failed(v).alias("shell")).collect()}
    assert got["null"][0] is None and got["two"][0] == "a"
    assert got["code"][1] is False  # the shell clients do not see an error here; Python/C# do


def test_outcome_class(spark):
    df = spark.createDataFrame([(202, '{"jobStatus":"inProgress"}'), (200, '{"jobStatus":"error"}'),
                                (200, '{"jobStatus":"finished"}'), (500, '{}')], "http int, json string")
    got = [r.o for r in df.select(J.outcome_class(F.col("http"), J.parsed(F.col("json"))).alias("o")).collect()]
    assert got == ["inProgress", "failed", "finished", "unexpected"]


def test_mode_and_timeout_validation(spark):
    df = spark.createDataFrame([("sync",), ("async",), ("batch",), (None,)], "mode string")
    assert [r.valid for r in J.mode_validation(df).collect()] == [True, True, False, False]
    ev = spark.createDataFrame([], "event_id long, job_id long, ts timestamp, status string")
    for bad in (0, -1, "x"):
        with pytest.raises(ValueError):
            J.job_timeouts(ev, F.current_timestamp(), bad)


def test_redacted_names(spark):
    from shroud.sources.files import redacted_name
    df = spark.createDataFrame([("a/b/report.v2.txt",), (".env",), ("report",)], "p string")
    got = [r.n for r in df.select(redacted_name(F.col("p")).alias("n")).collect()]
    assert got == ["report.v2_redacted.txt", ".env_redacted", "report_redacted"]


def test_token_carry(spark):
    rows = [
        # initial inProgress with reference and token, polled finished without token -> initial's
        (1, 1, "2024-01-01 00:00:00", '{"jobStatus":"inProgress","outputFiles":[{"fileCode":"fdf","fileId":"a","dekToken":"t"}]}'),
        (1, 2, "2024-01-01 00:00:02", '{"jobStatus":"finished","outputFiles":[{"fileCode":"fdf","fileId":"a"}]}'),
        # initial inProgress without reference -> the final answer's reference (no token)
        (2, 3, "2024-01-01 00:00:00", '{"jobStatus":"inProgress"}'),
        (2, 4, "2024-01-01 00:00:05", '{"jobStatus":"finished","outputFiles":[{"fileCode":"fdf","fileId":"b"}]}'),
        # initial finished: it is final, later answers do not matter
        (3, 5, "2024-01-01 00:00:00", '{"jobStatus":"finished","outputFiles":null}'),
        (3, 6, "2024-01-01 00:00:09", '{"jobStatus":"finished","outputFiles":[{"fileCode":"fdf","fileId":"c","dekToken":"u"}]}'),
    ]
    df = spark.createDataFrame(rows, "job_id long, event_id long, ts string, json string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.job_id: (r.fdf_file_id, r.token_present) for r in J.token_carry(df).collect()}
    assert got == {1: ("a", True), 2: ("b", False), 3: (None, False)}


# ---- fail closed ----
def _store(spark, slots=(0, 1, 2, 3)):
    from shroud.operators.protect import KEYS_SCHEMA
    return spark.createDataFrame([(f"k{s}", s, bytearray([s + 1] * 32)) for s in slots], KEYS_SCHEMA)


def _files(spark, keys, n=40):
    from shroud.sources import files as FS
    docs = spark.createDataFrame([(i, None if i == 7 else f"text {i}", "s") for i in range(n)], "doc_id long, text string, source string")
    return FS.ingest_local(docs, keys, F.lit("2024-01-10 00:00:00").cast("timestamp"))


def test_download_refuses_null_and_early_times(spark):
    from shroud.sources import files as FS
    keys = _store(spark)
    files = _files(spark, keys)
    when = {"0": None, "1": "2020-01-01 00:00:00", "2": "2024-01-10 00:00:00", "3": "2024-01-11 00:00:00", "4": "2024-01-11 00:00:01"}
    req = files.where(F.col("file_id").isin(*when)).select("file_id", "dek_token").join(
        spark.createDataFrame(list(when.items()), "file_id string, at string"), "file_id") \
        .select("file_id", F.when(F.col("file_id") != "5", F.col("dek_token")).alias("dek_token"), F.col("at").cast("timestamp").alias("requested_at"))
    req = req.unionByName(files.where("file_id = '5'").select("file_id", F.lit(None).cast("string").alias("dek_token"),
                                                             F.lit("2024-01-10 01:00:00").cast("timestamp").alias("requested_at")))
    granted, refused = FS.download(files, req, keys)
    assert {r.file_id for r in granted.collect()} == {"2", "3"}
    assert {r.file_id: r.reason for r in refused.collect()} == {
        "0": "no request time", "1": "not yet valid", "4": "expired", "5": "bad token"}


def test_key_rotation_loses_no_file(spark):
    from shroud.operators import protect as PR
    from shroud.sources import files as FS
    assert _files(spark, _store(spark, (0, 2))).count() == 40
    keys = _store(spark)
    files = _files(spark, keys)
    rest = keys.where("slot <> 1")
    prot = PR.protect(files, rest)
    assert prot.count() == 40
    gone = {r.file_id for r in files.where("key_id = 'k1'").collect()}
    assert gone and {r.file_id for r in prot.where("reason = 'unknown key'").collect()} == gone
    opened = {r.file_id: r for r in PR.unprotect(PR.protect(files, keys), files.select("file_id", "dek_token"), keys).collect()}
    assert opened["7"].reason == "no content" and all(r.reason is None for i, r in opened.items() if i != "7")
    late = {r.file_id: r.reason for r in PR.unprotect(PR.protect(files, keys), files.select("file_id", "dek_token"), rest).collect()}
    assert {i for i, r in late.items() if r == "unknown key"} == gone
    req = files.select("file_id", "dek_token", F.lit("2024-01-10 01:00:00").cast("timestamp").alias("requested_at"))
    granted, refused = FS.download(files, req, rest)
    assert {r.file_id for r in refused.collect()} == gone and granted.count() == 40 - len(gone)


WHOLE = [  # text, what a label leaves
    ("x " + "0123456789abcdef" * 4 + " y", "x [HEX_TOKEN] y"),
    ("card 4111111111111111222 end", "card [CARD] end"),
    ("ip 99999.1.1.1 end", "ip [IPV4] end"),
    ("amex 3782 822463 10005, mc 5555 5555 5555 4444, visa 4111-1111-1111-1111.", "amex [CARD], mc [CARD], visa [CARD]."),
    ("call 555-123-4567 or +44 20 7946 0958 or +1 (555) 123-4567", "call [PHONE] or [PHONE] or [PHONE]"),
    ("v6 2001:db8:0:0:0:ff00:42:8329 and fe80::1ff:fe23:4567:890a", "v6 [IPV6] and [IPV6]"),
]


def test_matches_take_the_whole_run(spark):
    from shroud.operators import detect as D
    from shroud.operators import redact as R
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WHOLE)], "i int, text string")
    got = {r.i: r.redacted_text for r in R.apply_redactions(D.detect_patterns(df), "text").collect()}
    assert got == {i: want for i, (_, want) in enumerate(WHOLE)}


def test_dropping_leaves_no_new_finding(spark):
    from shroud.operators import detect as D
    from shroud.operators import redact as R
    tok = "token = \"" + "a" * 16 + "\""
    df = spark.createDataFrame([(1, "10." + tok + "1.2.3"), (2, "keep " + tok + " this"), (3, None), (4, "none")], "i int, text string")
    out = R.apply_redactions(D.merge(D.detect_patterns(df)), "text", "findings", "drop", merged=True, stable=True)
    got = {r.i: r.redacted_text for r in out.collect()}
    assert got == {1: "10.[SECRET]1.2.3", 2: "keep  this", 3: None, 4: "none"}
    assert {r.n for r in R.residual_check(out).collect()} == {0}


def test_snippet_shows_no_neighbour(spark):
    from shroud.operators import detect as D
    from shroud.operators import review as RV
    df = spark.createDataFrame([(1, "s", "write a@b.example, 10.20.30.40 tail and more text"), (2, "s", "nothing")], "doc_id int, source string, text string")
    got = RV.review_queue(D.merge(D.detect_patterns(df)), 5).collect()
    assert [(r.doc_id, r.snippet) for r in got] == [(1, "write [EMAIL], [IPV4] tail and mo")]


CONFIGS = [  # configuration, error, findings
    (None, None, 2), ('{}', None, 2), ('{"detectors":["pattern"]}', None, 1), ('{"detectors":["ner"]}', None, 1),
    ('{"detectors":["pattern","keyword","ner"],"style":"drop"}', None, 3), ('{"entities":["email"],"threshold":1}', None, 1),
    ('{"detectors":["patern"]}', "unknown detector", None), ('{"detectors":[]}', "unknown detector", None),
    ('{"detectors":"pattern"}', "unknown detector", None), ('{"detectors":[null]}', "unknown detector", None),
    ('{"entities":["emial"]}', "unknown entity", None), ('{"style":"blur"}', "unknown style", None),
    ('{"threshold":"high"}', "invalid threshold", None), ('{"threshold":7}', "invalid threshold", None),
    ('{"detectors":', "invalid configuration", None), ('[1]', "invalid configuration", None), ('"x"', "invalid configuration", None),
]


def test_configuration_refuses_what_it_does_not_know(spark):
    from shroud.operators import config as C
    df = spark.createDataFrame([(i, "password of a@b.example, Eriner", c) for i, (c, _, _) in enumerate(CONFIGS)], "doc_id int, text string, config string")
    got = {r.doc_id: r for r in C.redact_configured(df).collect()}
    for i, (c, error, n) in enumerate(CONFIGS):
        r = got[i]
        assert (r.config_error, None if r.findings is None else len(r.findings)) == (error, n), c
        assert (r.redacted_text is None) == (error is not None), c
    assert got[0].redacted_text == "[SECRET_KEYWORD] of [EMAIL], Eriner" and got[4].redacted_text == " of , "


def test_scorer_cache_knows_options():
    from shroud.operators import ner as N
    a, b = (N.ScorerSpec(kind="lexicon", options={"terms": {w: "person"}}) for w in ("Ada", "Bob"))
    assert N.scorer_for(a) is not N.scorer_for(b) and N.scorer_for(a).predict("Ada, Bob Adam")[0][:2] == (0, 3)
    assert [s[:3] for s in N.scorer_for(b).predict("Ada, Bob Adam")] == [(5, 8, "person")]


def test_redaction_from_saved_files(spark, tmp_path):
    """Whole pretty-printed files, read back, normalised and applied."""
    import json

    from shroud.sources.sinks import load_redactions_json
    text = "mail a@b.example now"
    span = {"start": 5, "end": 16, "entity": "email"}
    cases = {
        1: {"result": {"redactions": [span]}}, 2: [span], 3: {"redactions": []}, 4: {"x": 1}, 5: [{"start": 5, "entity": "email"}],
        6: [{"start": 5, "end": 99, "entity": "email"}], 7: [span, {"start": 0, "end": 6, "entity": "note"}], 8: [{"start": 5, "end": 16}],
        9: [{"start": -1, "end": 2, "entity": "x"}], 10: "text"}
    for i, c in cases.items():
        (tmp_path / f"{i}.json").write_text(json.dumps(c, indent=2))
    saved = load_redactions_json(spark, str(tmp_path)).select(
        F.regexp_extract("source_file", r"([0-9]+)\.json$", 1).cast("int").alias("case_id"), "json")
    docs = spark.createDataFrame([(i, text) for i in [*cases, 11]] + [(12, None)], "doc_id int, text string")
    got = {r.doc_id: (r.redacted_text, r.n_redactions, r.reason) for r in J.redact_from_saved(docs, saved).collect()}
    done = "mail [EMAIL] now"
    assert got == {1: (done, 1, None), 2: (done, 1, None), 3: (text, 0, None), 4: (None, None, "no redactions"),
                   5: (None, None, "invalid span"), 6: (None, None, "invalid span"), 7: ("[EMAIL] now", 1, None),
                   8: (None, None, "invalid span"), 9: (None, None, "invalid span"), 10: (None, None, "no redactions"),
                   11: (None, None, "no redactions"), 12: (None, None, "no text")}


def test_encoded_addresses_are_found(spark):
    import html

    from shroud.operators import detect as D
    from shroud.sources.files import html_to_text
    pages = ["<p>jo&#64;b.example</p>", "jo&#x40;b.example", "jo&commat;b&period;example &amp;#64; &#128512;&#x1F600;&#0;&#xD800;", "plain", None, "&#9999999;"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", html_to_text(F.col("html")).alias("text"))
    got = {r.i: r.text for r in df.collect()}
    assert got == {0: "jo@b.example", 1: "jo@b.example", 2: html.unescape(pages[2]), 3: "plain", 4: None, 5: "\ufffd"}
    found = {r.i: [f.entity for f in r.findings] for r in D.detect_patterns(df).collect()}
    assert [found[i] for i in range(3)] == [["email"]] * 3


def test_redacted_output_is_addressed_by_id(spark, tmp_path):
    from shroud.sources.sinks import write_redacted
    df = spark.createDataFrame([("1", "a.txt", "x"), ("2", "a.txt", "y"), ("3", "", "z"), ("4", None, "w")], "file_id string, name string, redacted_text string")
    write_redacted(df, str(tmp_path / "out"))
    got = {r.file_id: r.redacted_name for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"1": "a_redacted.txt", "2": "a_redacted.txt", "3": "3_redacted", "4": "4_redacted"}


def test_one_row_per_use_with_its_latest_issue(spark):
    from shroud.operators import protect as PR
    t = lambda m: f"2024-01-{1 + m // 1440:02d} {m % 1440 // 60:02d}:{m % 60:02d}:00"
    schema = "event_id long, user_id long, ts string"
    issues = [(1, 7, t(0)), (2, 7, t(100)), (3, 7, t(100)), (4, 8, t(5000)), (5, 9, t(1430))]
    uses = [(11, 7, t(99)), (12, 7, t(100)), (13, 7, t(1540)), (14, 7, t(1541)), (15, 8, t(4999)), (16, 9, t(1430 + 1440)), (17, 5, t(1)),
            (18, 9, t(1431))]
    make = lambda rows: spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    want = {11: (1, 99), 12: (3, 0), 13: (3, 1440), 16: (5, 1440), 18: (5, 1)}
    for df in (PR.token_uses(make(issues), make(uses)), PR.latest_issue(PR.token_use_pairs(make(issues), make(uses)))):
        assert {r.use_id: (r.issue_id, r.minutes) for r in df.collect()} == want

"""Offsets, merge and redaction against a plain-Python oracle."""

import random
import re

from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.functions.spans import DETECTOR_RANK, SMALL_SPANS
from shroud.operators import detect as D
from shroud.operators import redact as R

EMAIL = P.EMAIL.regex


def py_findings(text, patterns=P.DEFAULT):
    out = []
    for p in patterns:
        for m in re.finditer(p.regex, text or ""):
            out.append((m.start(), m.end(), p.entity, "pattern"))
    return out


def py_merge(spans):
    """Islands of overlapping spans; label by (detector rank, longest, earliest, name)."""
    spans = sorted(spans)
    out = []
    for s in spans:
        if out and s[0] < out[-1]["end"]:
            isl = out[-1]
            isl["end"] = max(isl["end"], s[1])
            isl["members"].append(s)
        else:
            out.append({"start": s[0], "end": s[1], "members": [s]})
    res = []
    for isl in out:
        best = min(isl["members"], key=lambda m: (DETECTOR_RANK.get(m[3], 9), -(m[1] - m[0]), m[0], m[2]))
        res.append((isl["start"], isl["end"], best[2], best[3]))
    return res


def py_redact(text, spans, style="label"):
    if text is None:
        return None
    out, pos = [], 0
    for s, e, ent, _ in spans:
        out.append(text[pos:s])
        out.append({"label": f"[{ent.upper()}]", "mask": "*" * (e - s), "drop": ""}[style])
        pos = e
    out.append(text[pos:])
    return "".join(out)


PLANTED = [
    "éèç a@b.example",
    "😀 é x 🎉🎉 then mail@x.example and +1 (555) 123-4567",
    "only@one.example",
    "a@b.example" + "c@d.example",
    "token = \"" + "a" * 40 + "\" trailing",
    "price $1 and \\ backslash a@b.example \\1 $0",
    "",
    "nul\u0000char a@b.example and 10.0.0.1",
    "ip 1.2.3.4 5.6.7.8 card 4111111111111111",
    "\u0001\u0002 control a@b.example\u0003",
]


def _frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def _check(spark, texts, style="label"):
    df = D.merge(D.detect_patterns(_frame(spark, texts), "text", P.DEFAULT))
    df = R.apply_redactions(df, "text", "findings", style, merged=True)
    rows = {r.doc_id: r for r in df.collect()}
    for i, t in enumerate(texts):
        got = [(f.start, f.end, f.entity, f.detector) for f in rows[i].findings]
        want = py_merge(py_findings(t))
        assert got == want, (t[:80], got[:5], want[:5])
        assert rows[i].redacted_text == py_redact(t, want, style), t[:80]


def test_planted_cases(spark):
    _check(spark, PLANTED)


def test_null_text(spark):
    df = D.detect_patterns(spark.createDataFrame([(1, None)], "doc_id long, text string"), "text")
    out = R.apply_redactions(df, "text").collect()[0]
    assert out.findings == [] and out.redacted_text is None


def test_styles_and_many_matches(spark):
    rnd = random.Random(7)
    words = ["x", "é", "😀", "a@b.example", "10.1.2.3", "4111111111111111", "  ", "\n", "é"]
    texts = ["".join(rnd.choice(words) + " " for _ in range(rnd.randint(0, 60))) for _ in range(40)]
    # one text above each threshold: linear marker offsets and code-point-array cuts
    texts.append(" ".join(["u@v.example"] * (128)))
    texts.append("😀".join(["1.2.3.4"] * (SMALL_SPANS + 10)))
    for style in R.STYLES:
        _check(spark, texts, style)


def test_mask_keeps_length_and_no_span_is_identity(spark):
    texts = ["abc", "a@b.example x", "😀 1.2.3.4"]
    df = D.merge(D.detect_patterns(_frame(spark, texts), "text"))
    masked = R.apply_redactions(df, "text", "findings", "mask", merged=True).collect()
    for r in masked:
        assert len(r.redacted_text) == len(texts[r.doc_id])
    none = R.apply_redactions(df.withColumn("findings", F.expr("filter(findings, x -> false)")),
                              "text", "findings", "label", merged=True).collect()
    assert all(r.redacted_text == texts[r.doc_id] for r in none)


def test_overlaps_merge(spark):
    rows = [(1, "0123456789abcdef", [(0, 10, "a", "ner", 0.5), (2, 4, "b", "pattern", 1.0),
                                      (8, 12, "c", "keyword", 1.0), (12, 14, "d", "pattern", 1.0)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, findings array<struct<start:int,end:int,"
                                     "entity:string,detector:string,score:double>>")
    got = [(f.start, f.end, f.entity, f.detector) for f in D.merge(df).collect()[0].findings]
    # one island 0..12 labelled by the pattern member; 12..14 touches but stays apart
    assert got == [(0, 12, "b", "pattern"), (12, 14, "d", "pattern")]
    again = D.merge(D.merge(df)).collect()[0].findings
    assert [(f.start, f.end) for f in again] == [(0, 12), (12, 14)]


def test_driver_data_matches_python(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = D.explode_findings(D.detect_patterns(docs, "text"), ["doc_id"]).collect()
    want = {(d, s, e, ent) for d, t in texts.items() for s, e, ent, _ in py_findings(t)}
    assert {(r.doc_id, r.start, r.end_, r.entity) for r in got} == want


def test_merge_and_greedy_grow_linearly(spark):
    """16 times the spans in one text, overlapping in pairs: far from 256 times the time."""
    import time

    from shroud.functions.spans import FINDINGS_DDL, greedy_decode, merge_spans

    def run(n):
        spans = [(10 * (i // 2) + 3 * (i % 2), 10 * (i // 2) + 3 * (i % 2) + 5, "a", "ner", 0.5 + 0.1 * (i % 2)) for i in range(n)]
        df = spark.createDataFrame([(i, spans) for i in range(8)], f"i int, f {FINDINGS_DDL}").cache()
        df.count()
        out = df.select(F.expr(merge_spans("f")).alias("m"), F.expr(greedy_decode("f")).alias("g"))
        t = time.perf_counter()
        r = out.selectExpr("sum(size(m)) AS m", "sum(size(g)) AS g").first()
        assert (r.m, r.g) == (4 * n, 4 * n)
        return time.perf_counter() - t

    run(1000)
    small, large = min(run(1000) for _ in range(3)), min(run(16000) for _ in range(2))
    assert large < 60 * max(small, 0.05)

"""Properties on generated strings and spans (each example is one Spark job over a batch)."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shroud.functions import spans as S
from shroud.operators import detect as D
from shroud.operators import redact as R
from tests.test_spans import py_findings, py_merge, py_redact

PIECES = ["a", "é", "é", "😀", " ", "\n", "\u0000", "$1", "\\", "x@y.example", "10.0.0.7",
          "4111111111111111", "+1 (555) 123-4567", "token = \"" + "ab12" * 5 + "\"", "ß", "İ"]
texts = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)
FS = "array<struct<start:int,end:int,entity:string,detector:string,score:double>>"
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(st.lists(texts, min_size=1, max_size=30))
def test_offsets_and_redaction_match_python(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "doc_id long, text string")
    merged = D.merge(D.detect_patterns(df, "text"))
    for style in R.STYLES:
        out = {r.doc_id: r for r in R.apply_redactions(merged, "text", "findings", style, merged=True).collect()}
        for i, t in enumerate(batch):
            want = py_merge(py_findings(t))
            assert [(f.start, f.end, f.entity, f.detector) for f in out[i].findings] == want
            red = out[i].redacted_text
            assert red == py_redact(t, want, style)
            if style == "mask":
                assert len(red) == len(t)


span = st.tuples(st.integers(0, 60), st.integers(1, 12), st.sampled_from(["a", "b", "c"]),
                 st.sampled_from(list(S.DETECTOR_RANK) + ["other"]))


@SLOW
@given(st.lists(st.lists(span, max_size=15), min_size=1, max_size=25), st.randoms())
def test_merge_is_order_free_idempotent_and_disjoint(spark, docs, rnd):
    rows, shuffled = [], []
    for d, spans in enumerate(docs):
        items = [(s, s + ln, e, det, 1.0) for s, ln, e, det in spans]
        rows.append((d, items))
        copy = list(items)
        rnd.shuffle(copy)
        shuffled.append((d, copy))
    a = D.merge(spark.createDataFrame(rows, f"doc_id long, findings {FS}"))
    b = D.merge(spark.createDataFrame(shuffled, f"doc_id long, findings {FS}"))
    once = {r.doc_id: [tuple(f) for f in r.findings] for r in a.collect()}
    assert once == {r.doc_id: [tuple(f) for f in r.findings] for r in b.collect()}
    twice = {r.doc_id: [tuple(f) for f in r.findings] for r in D.merge(a).collect()}
    assert twice == once
    for d, items in rows:
        got = [(s, e, ent, det) for s, e, ent, det, _ in once[d]]
        assert got == py_merge([(s, e, ent, det) for s, e, ent, det, _ in items])
        assert all(got[i][1] <= got[i + 1][0] for i in range(len(got) - 1))


def test_text_outside_spans_untouched(spark):
    rnd = random.Random(11)
    rows = []
    for d in range(50):
        t = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30)))
        cuts = sorted(rnd.sample(range(len(t) + 1), k=min(len(t) + 1, 2 * rnd.randint(0, 4))))
        spans = [(cuts[i], cuts[i + 1], "x", "pattern", 1.0) for i in range(0, len(cuts) - 1, 2) if cuts[i] < cuts[i + 1]]
        rows.append((d, t, spans))
    df = spark.createDataFrame(rows, f"doc_id long, text string, findings {FS}")
    out = {r.doc_id: r.redacted_text for r in
           R.apply_redactions(df, "text", "findings", "drop", merged=True).collect()}
    for d, t, spans in rows:
        keep, pos = [], 0
        for s, e, *_ in spans:
            keep.append(t[pos:s])
            pos = e
        keep.append(t[pos:])
        assert out[d] == "".join(keep)
    none = df.withColumn("findings", F.expr(f"CAST(array() AS {FS})"))
    assert all(r.redacted_text == rows[r.doc_id][1]
               for r in R.apply_redactions(none, "text", "findings", "label", merged=True).collect())


def test_texts_reach_python_in_batches_bounded_by_bytes(spark):
    from shroud.session import ensure_settings
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    ensure_settings(spark)  # as every registered query does first
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 4 << 20
    df = spark.range(400, numPartitions=1).selectExpr("id", "repeat('x', 100000) AS text")
    sizes = df.mapInArrow(lambda bs: (b.select([]).from_arrays([[b.num_rows]], names=["n"]) for b in bs), "n long").collect()
    assert sum(r.n for r in sizes) == 400 and max(r.n for r in sizes) <= 60

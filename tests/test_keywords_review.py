"""Keyword paths agree; review decisions; greedy decoding against a Python loop."""

from pyspark.sql import functions as F

from shroud.functions.spans import greedy_decode
from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import review as RV
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((r.doc_id, r.start, r.end_, r.entity) for r in df.collect())


def test_literal_and_join_paths_agree(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    planted = spark.createDataFrame([(10**9, "The PASSWORD is here; released under the MIT   License."),
                                     (10**9 + 1, "mit license, Apache-License and passwords")],
                                    "doc_id long, text string")
    docs = docs.unionByName(planted)
    dic = K.keyword_dictionary(spark).unionByName(
        K.passage_dictionary(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")))
    lit = D.explode_findings(K.detect_keywords(docs, "text", dic, path="literal"), ["doc_id"])
    join = K.keyword_table(docs, ["doc_id"], "text", dic)
    via_join = D.explode_findings(K.detect_keywords(docs, "text", dic, key_cols=["doc_id"], path="join"), ["doc_id"])
    assert _rows(lit) == _rows(join) == _rows(via_join)
    got = {(r.doc_id, r.entity) for r in lit.collect() if r.doc_id >= 10**9}
    assert (10**9, "secret_keyword") in got and (10**9, "license") in got
    # whole words only: "passwords" is not "password"; "Apache-License" is two tokens, so it matches
    assert sorted(r.entity for r in lit.collect() if r.doc_id == 10**9 + 1) == ["license", "license"]


def test_same_rows_at_every_dictionary_size(spark):
    """Greek capitals and apostrophes: the lowered token decides, whatever the number of phrases."""
    docs = spark.createDataFrame([(1, "\u039f\u0394\u039f\u03a3'\u0391 rue"), (2, "l'eau \u00c9T\u00c9, unrelated 7 words here"), (3, None), (4, "")],
                                 "doc_id long, text string")
    base = [("street", "\u03bf\u03b4\u03bf\u03c2"), ("summer", "\u00e9t\u00e9"), ("water", "l eau")]
    want = None
    for n in (1, 65, 1001):
        dic = K.keyword_dictionary(spark, base + [("other", f"unrelated {i} words here") for i in range(n)])
        lit = _rows(D.explode_findings(K.detect_keywords(docs, "text", dic, path="literal"), ["doc_id"]))
        join = _rows(K.keyword_table(docs, ["doc_id"], "text", dic))
        assert lit == join
        seen = [r for r in lit if r[3] != "other"]
        assert want is None or seen == want
        want = seen
    assert {r[3] for r in want} == {"street", "summer", "water"}
    assert [r for r in lit if r[3] == "other"] == [(2, 11, 33, "other")]


def test_null_and_repeated_ids_agree_in_both_plans(spark):
    df = spark.createDataFrame([(None, "my password here"), (1, "my password here"), (1, "xx password password"), (1, "xx password password"),
                                (None, None), (2, ""), (None, "api  key, API KEY")], "doc_id int, text string")
    d = K.keyword_dictionary(spark)
    by = {}
    for path in ("literal", "join"):
        out = K.detect_keywords(df, "text", d, key_cols=["doc_id"], path=path).collect()
        by[path] = sorted((str(r.doc_id), str(r.text), sorted((f.start, f.end, f.entity) for f in r.findings)) for r in out)
    assert by["literal"] == by["join"] and len(by["join"]) == 7
    assert [[s for s, _, _ in f] for i, t, f in by["join"] if t == "my password here"] == [[3], [3]]
    assert [[s for s, _, _ in f] for i, t, f in by["join"] if t.startswith("xx")] == [[3, 12], [3, 12]]
    table = K.keyword_table(df, ["doc_id"], "text", d).collect()
    assert len(table) == 1 + 1 + 2 + 2 + 2


def test_shared_first_words_are_looked_up_by_the_whole_gram(spark):
    docs = spark.createDataFrame([(i, "the a b c the a b d " * 20) for i in range(5)], "doc_id long, text string")
    dic = K.keyword_dictionary(spark, [("e", f"the a b x{i}") for i in range(2000)] + [("e", "the a b c d"), ("e", "the a b d the")])
    found = K.detect_keywords(docs, "text", dic, key_cols=["doc_id"])
    assert found.selectExpr("sum(size(findings)) AS n").first().n == 5 * 19


def test_apply_decisions(spark):
    fs = "array<struct<start:int,end:int,entity:string,detector:string,score:double>>"
    docs = spark.createDataFrame([(1, "x" * 40, [(0, 5, "email", "pattern", 1.0), (10, 15, "ipv4", "pattern", 1.0)]),
                                  (2, "y" * 40, [(3, 6, "card", "pattern", 1.0)])], f"doc_id long, text string, findings {fs}")
    dec = spark.createDataFrame([
        (1, 0, 5, "accept", None, "r", "2024-01-01 00:00:00"),
        (1, 0, 5, "reject", None, "r", "2024-01-02 00:00:00"),   # later wins
        (1, 10, 15, "reject", None, "r", "2024-01-01 00:00:00"),
        (1, 10, 15, "accept", None, "r", "2024-01-03 00:00:00"),
        (1, 14, 20, "add", "name", "r", "2024-01-03 00:00:00"),  # overlaps a kept span: merged, review label wins
    ], "doc_id long, start int, end int, action string, entity string, reviewer string, decided_at string") \
        .withColumn("decided_at", F.col("decided_at").cast("timestamp"))
    out = {r.doc_id: [(f.start, f.end, f.entity, f.detector) for f in r.findings]
           for r in RV.apply_decisions(docs, dec).collect()}
    assert out == {1: [(10, 20, "name", "review")], 2: [(3, 6, "card", "pattern")]}
    rows = D.explode_findings(docs, ["doc_id"])
    outcome = {r.detector: (r.accepted, r.rejected, r.added, r.open) for r in RV.review_outcome(rows, dec).collect()}
    assert outcome == {"pattern": (1, 1, 0, 1), "review": (0, 0, 1, 0)}


def test_greedy_matches_python(spark):
    import random
    rnd = random.Random(3)
    data = []
    for d in range(30):
        spans = []
        for _ in range(rnd.randint(0, 12)):
            s = rnd.randint(0, 50)
            spans.append((s, s + rnd.randint(1, 10), rnd.choice("abc"), "ner", round(rnd.random(), 2)))
        data.append((d, spans))
    df = spark.createDataFrame(data, "doc_id long, f array<struct<start:int,end:int,entity:string,"
                                     "detector:string,score:double>>")
    got = {r.doc_id: [(x.start, x.end, x.entity) for x in r.g]
           for r in df.select("doc_id", F.expr(greedy_decode("f")).alias("g")).collect()}
    for d, spans in data:
        kept = []
        for s in sorted(spans, key=lambda x: (-x[4], x[0], x[1], x[2])):
            if not any(k[0] < s[1] and s[0] < k[1] for k in kept):
                kept.append(s)
        assert got[d] == sorted((k[0], k[1], k[2]) for k in kept)


def test_ner_interface(spark):
    from shroud.operators import ner as N
    texts = ["Alice Smith met Bob in Paris.", "", None, "lower case only", "Zoë Ärger and Éva"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spec = N.ScorerSpec(threshold=0.3)
    out = {r.doc_id: r for r in N.detect_ner(df, "text", spec).collect()}
    assert set(out) == set(range(len(texts)))
    for i, t in enumerate(texts):
        spans = out[i].ner
        assert all(0 <= s.start < s.end <= len(t or "") for s in spans)
        assert all(s.entity in spec.labels and s.score >= spec.threshold and s.detector == "ner" for s in spans)
        assert all(spans[j].end <= spans[j + 1].start for j in range(len(spans) - 1))  # greedy: no overlap
    assert out[3].ner == [] and out[1].ner == [] and out[2].ner == []
    # deterministic stand-in: the same spec gives the same spans
    again = {r.doc_id: r.ner for r in N.detect_ner(df, "text", spec).collect()}
    assert again == {k: v.ner for k, v in out.items()}

"""Registered queries: review H1-H3, greedy decoding D4, NER D3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.functions.spans import greedy_decode as greedy
from shroud.functions.spans import ref
from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import ner as N
from shroud.operators import review as RV
from shroud.plans import oracle as O
from shroud.plans import texts
from shroud.plans.q_keywords import DOC_KW, DOC_NER, DOC_PAT
from shroud.plans.registry import register
from shroud.sources.tables import table

T_FIRST = "2024-01-10 00:00:00"
T_LATER = "2024-01-11 00:00:00"
QUEUE_K = 3

NER_COLS = "doc_id, start, end_, entity, detector, score"
RAW_SQL = (f"SELECT {NER_COLS} FROM ({DOC_PAT}) AS p UNION ALL SELECT {NER_COLS} FROM {DOC_KW} AS k "
           f"UNION ALL SELECT {NER_COLS} FROM {DOC_NER} AS n")
REV_F = O.merged(RAW_SQL, "doc_id")
ADDS_SQL = ("SELECT l.doc_id AS doc_id, 0 AS start, CAST(least(10, length(d.text)) AS INTEGER) AS end_, "
            "'review_note' AS entity, 'review' AS detector, CAST(1.0 AS DOUBLE) AS score "
            "FROM labels AS l JOIN documents AS d ON l.doc_id = d.doc_id "
            "WHERE l.quality = 1 AND l.toxic = 1 AND length(d.text) > 0")


def detected(spark, sf_dir, cols=("doc_id", "text")) -> DataFrame:
    """Documents with the findings of the three detectors on the row (not merged)."""
    docs = texts.documents(spark, sf_dir, cols)
    pat = D.detect_patterns(docs, "text", P.DEFAULT)
    kw = K.detect_keywords(pat, "text", K.keyword_dictionary(spark), path="literal")
    return D.union_findings(N.detect_ner(kw, "text", N.LEXICON, out="__ner"), ["findings", "__ner"]).drop("__ner")


def derive_decisions(spark, sf_dir, findings_rows: DataFrame) -> DataFrame:
    """M11 rows derived from ``labels``: quality 0 -> every finding accepted
    first, then rejected (the later decision wins); toxic 1 -> accepted, plus a
    reviewer-added span at the start of the text; otherwise undecided."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    f = findings_rows.select("doc_id", "start", F.col("end_").alias("end")).join(labels, "doc_id", "inner")
    ts0, ts1 = F.lit(T_FIRST).cast("timestamp"), F.lit(T_LATER).cast("timestamp")
    bad = F.col("quality") == 0
    good = (F.col("quality") == 1) & (F.col("toxic") == 1)

    def one(cond, action, ts):
        return F.when(cond, F.struct(F.lit(action).alias("action"), ts.alias("decided_at")))

    # one pass over the findings: each row yields its 0-2 decisions
    per_finding = F.filter(F.array(one(bad, "accept", ts0), one(bad, "reject", ts1), one(good, "accept", ts0)),
                           lambda d: d.isNotNull())
    spans = f.select("doc_id", "start", "end", F.explode_outer(per_finding).alias("d")).where(F.col("d").isNotNull()) \
        .select("doc_id", "start", "end", "d.action", F.lit(None).cast("string").alias("entity"),
                F.lit("reviewer-1").alias("reviewer"), "d.decided_at")
    lens = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n_chars"))
    add_docs = labels.where((F.col("quality") == 1) & (F.col("toxic") == 1)).join(lens, "doc_id") \
        .where(F.col("n_chars") > 0)
    adds = add_docs.select("doc_id", F.lit(0).alias("start"), F.least(F.lit(10), F.col("n_chars")).alias("end"),
                           F.lit("add").alias("action"), F.lit("review_note").alias("entity"),
                           F.lit("reviewer-1").alias("reviewer"), ts1.alias("decided_at"))
    return spans.unionByName(adds)


def decidable(spark, sf_dir):
    """Document ids whose labels can yield a decision (the rest stay open)."""
    return (table(spark, sf_dir, "labels").where((F.col("quality") == 0) | (F.col("toxic") == 1))
            .select("doc_id"))


def reviewed_docs(spark, sf_dir, cols=("doc_id", "text")) -> tuple[DataFrame, DataFrame]:
    """(documents with merged findings, decisions derived for them)."""
    merged = D.merge(detected(spark, sf_dir, cols))
    labelled = merged.join(decidable(spark, sf_dir), "doc_id", "left_semi")
    decisions = derive_decisions(spark, sf_dir, D.explode_findings(labelled, ["doc_id"]))
    return merged, decisions


@register("apply_decisions",
          sql=(f"SELECT doc_id, start, end_, entity, detector FROM ("
               + O.merged(f"SELECT * FROM ({REV_F}) AS m WHERE doc_id NOT IN "
                          f"(SELECT doc_id FROM labels WHERE quality = 0) UNION ALL {ADDS_SQL}", "doc_id")
               + ") AS x"))
def apply_decisions(spark, sf_dir):
    merged, decisions = reviewed_docs(spark, sf_dir)
    return D.explode_findings(RV.apply_decisions(merged, decisions), ["doc_id"])


@register("review_outcome",
          sql=("SELECT detector, count_if(acc) AS accepted, count_if(rej) AS rejected, count_if(ad) AS added, "
               "count_if(op) AS open FROM (SELECT m.detector AS detector, "
               "coalesce(l.quality = 1 AND l.toxic = 1, false) AS acc, coalesce(l.quality = 0, false) AS rej, "
               "false AS ad, NOT coalesce(l.quality = 0 OR (l.quality = 1 AND l.toxic = 1), false) AS op "
               f"FROM ({REV_F}) AS m LEFT JOIN labels AS l ON m.doc_id = l.doc_id "
               f"UNION ALL SELECT 'review', false, false, true, false FROM ({ADDS_SQL}) AS a) AS t "
               "GROUP BY detector"))
def review_outcome(spark, sf_dir):
    merged, decisions = reviewed_docs(spark, sf_dir)
    return RV.review_outcome(D.explode_findings(merged, ["doc_id"]), decisions)


_SNIP = ("substring(d.text, greatest(f.s - 20, 0) + 1, f.s - greatest(f.s - 20, 0)) || '[' || upper(f.ent) || ']' "
         "|| substring(d.text, f.e + 1, 20)")


@register("review_queue",
          sql=("SELECT source, rank, doc_id, n, substring(red, start + 1, s - start + length(ent) + 2 + 20) AS snippet FROM ("
               "SELECT d.source AS source, d.doc_id AS doc_id, f.n AS n, f.s AS s, greatest(f.s - 20, 0) AS start, f.ent AS ent, "
               "x.redacted_text AS red, CAST(row_number() OVER (PARTITION BY d.source ORDER BY f.n DESC, d.doc_id) AS INTEGER) AS rank "
               "FROM (SELECT doc_id, CAST(count(*) AS INTEGER) AS n, first(start ORDER BY start) AS s, "
               f"first(entity ORDER BY start) AS ent FROM ({REV_F}) AS r GROUP BY doc_id) AS f "
               f"JOIN documents AS d ON f.doc_id = d.doc_id JOIN ({O.redacted('documents', 'doc_id', REV_F)}) AS x "
               f"ON x.doc_id = d.doc_id) AS q WHERE rank <= {QUEUE_K}"))
def review_queue(spark, sf_dir):
    merged = D.merge(detected(spark, sf_dir, ("doc_id", "text", "source")))
    return RV.review_queue(merged, QUEUE_K)


_GREEDY_SQL = (
    "WITH RECURSIVE f AS (SELECT doc_id, start, end_, entity, detector, row_number() OVER "
    f"(PARTITION BY doc_id ORDER BY start, end_, entity, detector) AS rn FROM ({RAW_SQL}) AS r), "
    "walk(doc_id, rn, last_end, keep) AS (SELECT doc_id, rn, end_, true FROM f WHERE rn = 1 "
    "UNION ALL SELECT f.doc_id, f.rn, CASE WHEN f.start >= w.last_end THEN f.end_ ELSE w.last_end END, "
    "f.start >= w.last_end FROM walk AS w JOIN f ON f.doc_id = w.doc_id AND f.rn = w.rn + 1) "
    "SELECT f.doc_id, f.start, f.end_, f.entity, f.detector FROM walk JOIN f "
    "ON walk.doc_id = f.doc_id AND walk.rn = f.rn WHERE walk.keep")


@register("greedy_decode", sql=_GREEDY_SQL)
def greedy_decode(spark, sf_dir):
    found = detected(spark, sf_dir)
    return D.explode_findings(found.withColumn("findings", F.expr(greedy(ref("findings")))), ["doc_id"])


@register("detect_ner", sql=f"SELECT doc_id, start, end_, entity, score FROM {DOC_NER} AS n")
def detect_ner(spark, sf_dir):
    """The lexicon scorer (the hashed stand-in is covered by tests of the interface)."""
    found = N.detect_ner(texts.documents(spark, sf_dir), "text", N.LEXICON)
    return D.explode_findings(found, ["doc_id"], col="ner", with_score=True).drop("detector")

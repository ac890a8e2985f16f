"""Registered queries: detection, merge, redaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.operators import redact as R
from shroud.plans import oracle as O
from shroud.plans import texts
from shroud.plans.registry import register
from shroud.session import scratch_path
from shroud.sources.sinks import write_annotations, read_annotations

FINDING_COLS = "start, end_, entity, detector"

# ---- SQL building blocks over the pre-registered views ----
DOC_F = O.pattern_findings("documents", "doc_id")
PAGE_F = O.pattern_findings(O.PAGES_TEXT, "page_id")
CONV_F = O.pattern_findings("conversations", "conv_id, turn")
DOC_M = O.merged(DOC_F, "doc_id")
PAGE_M = O.merged(PAGE_F, "page_id")
CONV_M = O.merged(CONV_F, "conv_id, turn")


def _json_sql(m: str, key: str) -> str:
    item = ("'{\"start\":' || start || ',\"end\":' || end_ || ',\"entity\":\"' || entity || "
            "'\",\"detector\":\"' || detector || '\"}'")
    return (f"SELECT d.{key} AS {key}, CAST(coalesce(r.n, 0) AS INTEGER) AS n_redactions, "
            f"coalesce(r.js, '[]') AS redactions_json FROM documents AS d LEFT JOIN ("
            f"SELECT {key}, count(*) AS n, '[' || string_agg({item}, ',' ORDER BY start) || ']' AS js "
            f"FROM ({m}) AS m GROUP BY {key}) AS r ON d.{key} = r.{key}")


# ---- Spark side ----
def doc_findings(spark: SparkSession, sf_dir: str, cols=("doc_id", "text")) -> DataFrame:
    return D.detect_patterns(texts.documents(spark, sf_dir, cols), "text", P.DEFAULT)


@register("detect_pattern_documents", sql=f"SELECT doc_id, {FINDING_COLS} FROM ({DOC_F}) AS x")
def detect_pattern_documents(spark, sf_dir):
    return D.explode_findings(doc_findings(spark, sf_dir), ["doc_id"])


@register("detect_pattern_pages", sql=f"SELECT page_id, {FINDING_COLS} FROM ({PAGE_F}) AS x")
def detect_pattern_pages(spark, sf_dir):
    found = D.detect_patterns(texts.pages_text(spark, sf_dir), "text", P.DEFAULT)
    return D.explode_findings(found, ["page_id"])


@register("detect_pattern_conversations",
          sql=f"SELECT conv_id, turn, {FINDING_COLS} FROM ({CONV_F}) AS x")
def detect_pattern_conversations(spark, sf_dir):
    found = D.detect_patterns(texts.conversations(spark, sf_dir), "text", P.DEFAULT)
    return D.explode_findings(found, ["conv_id", "turn"])


@register("merge_overlaps", sql=f"SELECT doc_id, {FINDING_COLS} FROM ({DOC_M}) AS x")
def merge_overlaps(spark, sf_dir):
    return D.explode_findings(D.merge(doc_findings(spark, sf_dir)), ["doc_id"])


@register("redact_documents", sql=O.redacted("documents", "doc_id", DOC_M))
def redact_documents(spark, sf_dir):
    merged = D.merge(doc_findings(spark, sf_dir))
    out = R.apply_redactions(merged, "text", "findings", "label", merged=True)
    return out.select("doc_id", F.size("findings").alias("n_redactions"), "redacted_text")


@register("redact_pages", sql=O.redacted(O.PAGES_TEXT, "page_id", PAGE_M))
def redact_pages(spark, sf_dir):
    found = D.merge(D.detect_patterns(texts.pages_text(spark, sf_dir), "text", P.DEFAULT))
    out = R.apply_redactions(found, "text", "findings", "label", merged=True)
    return out.select("page_id", F.size("findings").alias("n_redactions"), "redacted_text")


@register("redact_conversations", sql=O.redacted("conversations", "conv_id, turn", CONV_M))
def redact_conversations(spark, sf_dir):
    found = D.merge(D.detect_patterns(texts.conversations(spark, sf_dir), "text", P.DEFAULT))
    out = R.apply_redactions(found, "text", "findings", "label", merged=True)
    return out.select("conv_id", "turn", F.size("findings").alias("n_redactions"), "redacted_text")


def _residual_sql() -> str:
    """Redact in all three styles (a dropped text that shows a new finding is labelled), then scan again."""
    by = {s: O.redacted("documents", "doc_id", DOC_M, style=s) for s in R.STYLES}
    anew = " OR ".join(f"len(regexp_extract_all(d.redacted_text, {O.q(p.regex)})) > len(regexp_extract_all(l.redacted_text, {O.q(p.regex)}))"
                       for p in P.DEFAULT)
    drop = (f"SELECT CASE WHEN d.n_redactions > 0 AND ({anew}) THEN l.redacted_text ELSE d.redacted_text END AS t "
            f"FROM ({by['drop']}) AS d JOIN ({by['label']}) AS l ON d.doc_id = l.doc_id")
    texts_ = " UNION ALL ".join([f"SELECT redacted_text AS t FROM ({by[s]}) AS r" for s in ("label", "mask")] + [drop])
    counts = ", ".join(f"coalesce(sum(len(regexp_extract_all(t, {O.q(p.regex)}))), 0) AS n{i}" for i, p in enumerate(P.DEFAULT))
    rows = " UNION ALL ".join(f"SELECT {O.q(p.entity)} AS entity, CAST(n{i} AS BIGINT) AS n FROM c" for i, p in enumerate(P.DEFAULT))
    return f"WITH x AS ({texts_}), c AS (SELECT {counts} FROM x) {rows}"


@register("residual_check", sql=_residual_sql())
def residual_check(spark, sf_dir):
    """R5 on all three styles at once: every redacted output is rescanned."""
    df = D.merge(doc_findings(spark, sf_dir))
    for s in R.STYLES:
        df = R.apply_redactions(df, "text", "findings", s, out=f"redacted_{s}", merged=True, stable=True)
    return R.residual_check(df, [f"redacted_{s}" for s in R.STYLES], P.DEFAULT)


@register("detection_result", sql=_json_sql(DOC_M, "doc_id"))
def detection_result(spark, sf_dir):
    return D.detection_result(D.merge(doc_findings(spark, sf_dir)), "doc_id")


@register("detection_response", sql=(
    "SELECT 'detect-' || CAST(d.doc_id AS VARCHAR) AS job_id, CASE WHEN text IS NULL THEN 'error' ELSE 'finished' END AS status, "
    "CASE WHEN text IS NULL THEN '[]' ELSE '[{\"fileCode\":\"fdf\",\"fileId\":\"fdf-' || CAST(d.doc_id AS VARCHAR) || '\"}]' END AS output_files, "
    "CASE WHEN text IS NOT NULL THEN r.n_redactions END AS n_redactions, CASE WHEN text IS NOT NULL THEN r.redactions_json END AS redactions_json, "
    f"CASE WHEN text IS NULL THEN 'no text' END AS error FROM documents AS d JOIN ({_json_sql(DOC_M, 'doc_id')}) AS r ON d.doc_id = r.doc_id"))
def detection_response(spark, sf_dir):
    docs = doc_findings(spark, sf_dir)
    return D.detection_response(D.merge(docs), "doc_id").withColumn("output_files", F.to_json("output_files"))


@register("annotations", sql=_json_sql(DOC_M, "doc_id"))
def annotations(spark, sf_dir):
    """The annotation artefact is written (partitioned by job), then read back."""
    merged = D.merge(doc_findings(spark, sf_dir)).select(
        F.lit("detect-1").alias("job_id"), "doc_id", F.col("doc_id").cast("string").alias("file_id"),
        F.col("findings").alias("redactions"))
    path = scratch_path(spark, "annotations", f"run-{spark.sparkContext.applicationId}-{_uid()}")
    write_annotations(merged, path)
    back = read_annotations(spark, path)
    return back.select("doc_id", F.size("redactions").alias("n_redactions"),
                       D.findings_json("redactions").alias("redactions_json"))


@register("redaction_count",
          sql=("SELECT d.doc_id AS doc_id, CAST(count(m.start) AS INTEGER) AS n FROM documents AS d "
               f"LEFT JOIN ({DOC_M}) AS m ON d.doc_id = m.doc_id GROUP BY d.doc_id"))
def redaction_count(spark, sf_dir):
    merged = D.merge(doc_findings(spark, sf_dir))
    return merged.select("doc_id", F.size("findings").alias("n"))


@register("entity_profile",
          sql=("SELECT entity, coalesce(lang, '*') AS lang, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_docs FROM ("
               f"SELECT m.doc_id, m.entity, d.lang, count(*) AS n FROM ({DOC_M}) AS m "
               "JOIN documents AS d ON m.doc_id = d.doc_id GROUP BY m.doc_id, m.entity, d.lang) AS t "
               "GROUP BY ROLLUP (entity, lang) HAVING entity IS NOT NULL"))
def entity_profile(spark, sf_dir):
    merged = D.merge(doc_findings(spark, sf_dir, ("doc_id", "text", "lang")))
    return D.entity_profile(D.explode_findings(merged, ["doc_id", "lang"]), "doc_id", "lang")


# ---- R1 -> R2 -> R4: the saved result of a detection, some edited wrongly ----
_SAVED_REASON = ("CASE WHEN d.doc_id % 7 = 3 THEN 'no redactions' WHEN d.doc_id % 7 = 4 THEN 'invalid span' END")


@register("redact_from_saved",
          sql=(f"SELECT d.doc_id, CASE WHEN {_SAVED_REASON} IS NULL THEN CASE WHEN d.doc_id % 7 = 6 THEN 0 ELSE r.n_redactions END END AS n_redactions, "
               f"CASE WHEN {_SAVED_REASON} IS NULL THEN CASE WHEN d.doc_id % 7 = 6 THEN d.text ELSE r.redacted_text END END AS redacted_text, "
               f"{_SAVED_REASON} AS reason FROM documents AS d JOIN ({O.redacted('documents', 'doc_id', DOC_M)}) AS r ON d.doc_id = r.doc_id"))
def redact_from_saved(spark, sf_dir):
    """Detection results saved as JSON (objects, plain arrays, empty and faulty ones), normalised and applied."""
    from shroud.operators import jobs as J
    js = D.findings_json("findings")
    rule = F.col("doc_id") % 7
    body = (F.when(rule == 3, F.lit('{"x":1}'))
            .when(rule == 4, F.lit('[{"start":0,"end":100000000,"entity":"email"}]'))
            .when(rule == 5, js)
            .when(rule == 6, F.lit('{"result":{"redactions":[]}}'))
            .otherwise(F.concat(F.lit('{"result":{"redactions":'), js, F.lit("}}"))))
    saved = D.merge(doc_findings(spark, sf_dir)).select(F.col("doc_id").alias("case_id"), body.alias("json"))
    return J.redact_from_saved(texts.documents(spark, sf_dir), saved)




def _uid() -> str:
    import uuid
    return uuid.uuid4().hex[:12]


# ---- verified numbers: only what can be a card or an address ----
def _verified_sql() -> str:
    digits = "string_split(regexp_replace(m, '[ -]', '', 'g'), '')"
    luhn = (f"length(regexp_replace(m, '[ -]', '', 'g')) BETWEEN 13 AND 19 AND list_sum(list_transform(list_reverse({digits}), lambda d, i: "
            "CASE WHEN i % 2 = 1 THEN d::INT WHEN d::INT > 4 THEN 2 * d::INT - 9 ELSE 2 * d::INT END)) % 10 = 0")
    octets = "len(string_split(m, '.')) = 4 AND len(list_filter(string_split(m, '.'), lambda x: length(x) > 3 OR x::HUGEINT > 255)) = 0"
    found = O.pattern_findings("documents", "doc_id", patterns=P.VERIFIED)
    return (f"SELECT f.doc_id, start, end_, entity, detector FROM (SELECT f.*, substring(d.text, start + 1, end_ - start) AS m FROM ({found}) AS f "
            f"JOIN documents AS d ON f.doc_id = d.doc_id) AS f WHERE CASE entity WHEN 'card' THEN {luhn} ELSE {octets} END")


@register("detect_verified", sql=_verified_sql())
def detect_verified(spark, sf_dir):
    """Card numbers whose check digit is right and addresses with four octets."""
    return D.explode_findings(D.detect_patterns(texts.documents(spark, sf_dir), "text", P.VERIFIED), ["doc_id"])


# ---- texts of any size: those above a limit are scanned and redacted in pieces ----
#: The longest documents here have some 100 kB, so the limit is set where a tenth of the text lies above it.
OVERSIZED = {"limit": 8 << 10, "piece_chars": 4 << 10}


@register("detect_oversized", sql=f"SELECT doc_id, {FINDING_COLS} FROM ({DOC_F}) AS x")
def detect_oversized(spark, sf_dir):
    from shroud.operators import oversized as Z
    docs = texts.documents(spark, sf_dir, ("doc_id", "text", "n_chars"))
    return D.explode_findings(Z.detect(docs, ["doc_id"], size=F.col("n_chars"), **OVERSIZED), ["doc_id"])


@register("redact_oversized", sql=O.redacted("documents", "doc_id", DOC_M))
def redact_oversized(spark, sf_dir):
    from shroud.operators import oversized as Z
    docs = texts.documents(spark, sf_dir, ("doc_id", "text", "n_chars"))
    merged = D.merge(Z.detect(docs, ["doc_id"], size=F.col("n_chars"), **OVERSIZED))
    out = Z.redact(merged, ["doc_id"], size=F.col("n_chars"), **OVERSIZED)
    return out.select("doc_id", F.size("findings").alias("n_redactions"), "redacted_text")

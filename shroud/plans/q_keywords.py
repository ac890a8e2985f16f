"""Registered queries: keywords and phrases D2, configuration D5, union D6."""

from __future__ import annotations

from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import config as C
from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import ner as N
from shroud.plans import oracle as O
from shroud.plans import texts
from shroud.plans.registry import register
from shroud.sources.tables import table

KW_DICT = O.dictionary(O.keyword_values(K.KEYWORDS))
PASSAGE_DICT = O.dictionary("SELECT 'benchmark' AS entity, text AS phrase FROM benchmark")
DOC_KW = O.keyword_findings("documents", "doc_id", KW_DICT)
DOC_PASSAGES = O.keyword_findings("documents", "doc_id", PASSAGE_DICT)
DOC_PAT = O.pattern_findings("documents", "doc_id")
DOC_NER = O.lexicon_findings("documents", "doc_id", N.LEXICON)
COLS = "doc_id, start, end_, entity, detector"


@register("detect_keyword", sql=f"SELECT {COLS} FROM {DOC_KW} AS k")
def detect_keyword(spark, sf_dir):
    """Built-in keyword list, carried in the expression (no join)."""
    docs = texts.documents(spark, sf_dir)
    found = K.detect_keywords(docs, "text", K.keyword_dictionary(spark), path="literal")
    return D.explode_findings(found, ["doc_id"])


@register("detect_phrase", sql=f"SELECT {COLS} FROM {DOC_PASSAGES} AS k")
def detect_phrase(spark, sf_dir):
    """Benchmark passages in documents, joined on the hash of their first n-gram."""
    docs = texts.documents(spark, sf_dir)
    passages = K.passage_dictionary(table(spark, sf_dir, "benchmark"))
    found = K.detect_keywords(docs, "text", passages, key_cols=["doc_id"])
    return D.explode_findings(found, ["doc_id"])


@register("union_findings",
          sql=(f"SELECT {COLS} FROM ({DOC_PAT}) AS p UNION ALL SELECT {COLS} FROM {DOC_KW} AS k "
               f"UNION ALL SELECT {COLS} FROM {DOC_NER} AS n"))
def union_findings(spark, sf_dir):
    """The three detectors end in one array per document."""
    docs = texts.documents(spark, sf_dir)
    pat = D.detect_patterns(docs, "text", P.DEFAULT, out="f_pattern")
    kw = K.detect_keywords(pat, "text", K.keyword_dictionary(spark), out="f_keyword", path="literal")
    ner = N.detect_ner(kw, "text", N.LEXICON, out="f_ner")
    return D.explode_findings(D.union_findings(ner, ["f_pattern", "f_keyword", "f_ner"], out="findings"), ["doc_id"])


# ---- D5: per-request detection configuration ----
# Requests carry a configuration chosen by the document's language, and every eleventh
# one a detector that doesn't exist, so every branch (absent, detector subset, entity
# subset, threshold, refusal) meets real rows.
CONFIG_BY_LANG = {
    "fr": '{"detectors":["pattern"],"entities":["email","phone","card"]}',
    "de": '{"detectors":["keyword"]}',
    "es": '{"detectors":["pattern","keyword","ner"],"threshold":0.5,"style":"mask"}',
    "en": '{"detectors":["pattern","keyword","ner"],"threshold":0.95}',
}
BAD_CONFIG = '{"detectors":["patern"]}'
BAD_RULE = "doc_id % 11 = 5"


def with_config(docs):
    cfg = F.lit(None).cast("string")
    for lang, js in CONFIG_BY_LANG.items():
        cfg = F.when(F.col("lang") == lang, F.lit(js)).otherwise(cfg)
    return docs.withColumn("config", F.when(F.expr(BAD_RULE), F.lit(BAD_CONFIG)).otherwise(cfg))


_CFG_F = (f"SELECT p.* FROM ({DOC_PAT}) AS p JOIN documents AS d USING (doc_id) "
          f"WHERE coalesce(d.lang, '') <> 'de' AND (d.lang IS DISTINCT FROM 'fr' OR p.entity IN ('email', 'phone', 'card')) AND NOT d.{BAD_RULE} "
          f"UNION ALL SELECT k.* FROM {DOC_KW} AS k JOIN documents AS d USING (doc_id) "
          f"WHERE coalesce(d.lang, '') <> 'fr' AND NOT d.{BAD_RULE} "
          f"UNION ALL SELECT n.* FROM {DOC_NER} AS n JOIN documents AS d USING (doc_id) WHERE d.lang = 'es' AND NOT d.{BAD_RULE}")


@register("detection_config", sql=f"SELECT {COLS} FROM ({_CFG_F}) AS c")
def detection_config(spark, sf_dir):
    docs = with_config(texts.documents(spark, sf_dir, ("doc_id", "text", "lang")))
    return D.explode_findings(C.apply_config(docs), ["doc_id"])


_REDACTED = O.redacted("documents", "doc_id", O.merged(_CFG_F, "doc_id"),
                       style="sql:CASE lang WHEN 'es' THEN 'mask' ELSE 'label' END", extra=("lang",))


@register("redact_configured",
          sql=(f"SELECT doc_id, CASE WHEN NOT {BAD_RULE} THEN n_redactions END AS n_redactions, CASE WHEN NOT {BAD_RULE} THEN redacted_text END "
               f"AS redacted_text, CASE WHEN {BAD_RULE} THEN 'unknown detector' END AS config_error FROM ({_REDACTED}) AS r"))
def redact_configured(spark, sf_dir):
    """D5 + R4: each request's configuration picks detectors, entities and the redaction
    style (a column, applied row by row); a refused request gets a reason and no text."""
    docs = with_config(texts.documents(spark, sf_dir, ("doc_id", "text", "lang")))
    out = C.redact_configured(docs)
    return out.select("doc_id", F.when(F.col("findings").isNotNull(), F.size("findings")).alias("n_redactions"), "redacted_text", "config_error")

"""Per-request detection configuration, checked before it is used.

A configuration is optional JSON: ``detectors`` and ``entities`` (lists), ``threshold``
(0 to 1) and ``style``.  Absent fields (and an absent configuration) take the
defaults.  Anything else wrong is a refusal: broken JSON, a field of the wrong type, an
unknown detector, entity or style.  A refused request gets its row with ``config_error``,
no findings and no redacted text; it never falls back to detecting less.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import ner as N
from shroud.operators.redact import STYLES, apply_redactions

DETECTORS = ("pattern", "keyword", "ner")
DEFAULT_DETECTORS = ("pattern", "keyword")


def known_entities(patterns=P.DEFAULT, rows=K.KEYWORDS, spec: N.ScorerSpec | None = None) -> tuple[str, ...]:
    return tuple(sorted({p.entity for p in patterns} | {e for e, _ in rows} | set((spec or N.LEXICON).labels)))


def checked_config(df: DataFrame, config_col: str = "config", entities=None) -> DataFrame:
    """Adds ``_det``, ``_ents`` (null: all), ``_thr``, ``style`` and ``config_error`` (null: accepted)."""
    entities = known_entities() if entities is None else tuple(entities)
    raw = F.col(config_col)
    v = F.try_parse_json(raw)
    given = lambda f: F.coalesce(F.try_variant_get(v, f"$.{f}", "string") != "null", F.lit(False)) | \
        F.try_variant_get(v, f"$.{f}", "array<string>").isNotNull()
    det, ents = (F.try_variant_get(v, f"$.{f}", "array<string>") for f in ("detectors", "entities"))
    thr, style = F.try_variant_get(v, "$.threshold", "double"), F.try_variant_get(v, "$.style", "string")
    known = lambda a, names: F.forall(a, lambda x: F.coalesce(x.isin(*names), F.lit(False)))
    error = (F.when(raw.isNull(), F.lit(None).cast("string"))
             .when(v.isNull() | ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), F.lit("invalid configuration"))
             .when(given("detectors") & (det.isNull() | (F.size(det) == 0) | ~known(det, DETECTORS)), F.lit("unknown detector"))
             .when(given("entities") & (ents.isNull() | ~known(ents, entities)), F.lit("unknown entity"))
             .when(given("threshold") & (thr.isNull() | F.isnan(thr) | ~thr.between(0, 1)), F.lit("invalid threshold"))
             .when(given("style") & ~F.coalesce(style.isin(*STYLES), F.lit(False)), F.lit("unknown style")))
    refused = error.isNotNull()
    return df.select(
        "*", F.when(~refused, F.coalesce(det, F.array(*[F.lit(d) for d in DEFAULT_DETECTORS]))).alias("_det"), ents.alias("_ents"),
        F.coalesce(thr, F.lit(0.0)).alias("_thr"), F.coalesce(style, F.lit("label")).alias("style"), error.alias("config_error"))


def apply_config(df: DataFrame, text_col: str = "text", config_col: str = "config", spec: N.ScorerSpec | None = None) -> DataFrame:
    """``df`` with ``findings`` (null when refused), ``style`` and ``config_error``.  Each
    detector runs only on rows that enable it; findings are narrowed to the allowed
    entities and the score threshold."""
    on = lambda d: F.coalesce(F.array_contains("_det", d), F.lit(False))
    staged = checked_config(df, config_col)
    staged = D.detect_patterns(staged, text_col, P.DEFAULT, out="findings", enabled=on("pattern"))
    staged = K.detect_keywords(staged, text_col, K.keyword_dictionary(df.sparkSession), out="findings", path="literal", enabled=on("keyword"))
    staged = N.detect_ner(staged.withColumn("__ner_text", F.when(on("ner"), F.col(text_col))), "__ner_text", spec or N.LEXICON, out="__ner")
    staged = D.union_findings(staged, ["findings", "__ner"], out="findings").drop("__ner", "__ner_text")
    kept = F.filter("findings", lambda f: (F.col("_ents").isNull() | F.array_contains(F.col("_ents"), f["entity"]))
                    & (f["score"] >= F.col("_thr")))
    return staged.withColumn("findings", F.when(F.col("config_error").isNull(), kept)).drop("_det", "_ents", "_thr")


def redact_configured(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """D5 + R4: adds ``redacted_text``; null, with ``config_error``, for a refused request."""
    found = D.merge(apply_config(df, text_col, **options))
    out = apply_redactions(found, text_col, "findings", "style", merged=True, stable=True)
    ok = F.col("config_error").isNull()
    return out.withColumns({"findings": F.when(ok, F.col("findings")), "redacted_text": F.when(ok, F.col("redacted_text"))})

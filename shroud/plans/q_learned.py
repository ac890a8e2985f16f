"""Registered queries: the learnt span scorer (D3), fitted on the findings of the other detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.operators import ner as N
from shroud.operators import tagger as T
from shroud.plans import texts
from shroud.plans.registry import register

LABELS = tuple(sorted({p.entity for p in P.DEFAULT} | set(N.LEXICON.labels)))


def labelled(spark, sf_dir) -> DataFrame:
    """``doc_id, text, gold, held_out``: findings of patterns and lexicon, merged; a third of the ids is held out."""
    found = D.detect_patterns(texts.documents(spark, sf_dir), "text", P.DEFAULT)
    found = D.union_findings(N.detect_ner(found, "text", N.LEXICON, out="__ner"), ["findings", "__ner"])
    return D.merge(found, "findings", "gold").select(
        "doc_id", "text", "gold", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"))


def fitted(spark, sf_dir) -> tuple[DataFrame, N.ScorerSpec]:
    rows = labelled(spark, sf_dir)
    return rows, T.scorer_spec(T.fit(rows.where("NOT coalesce(held_out, false)"), "text", "gold", LABELS))


@register("detect_learned")
def detect_learned(spark, sf_dir):
    """The learnt scorer over all documents; it sees their text only."""
    _, spec = fitted(spark, sf_dir)
    found = N.detect_ner(texts.documents(spark, sf_dir), "text", spec)
    return D.explode_findings(found, ["doc_id"], col="ner", with_score=True).drop("detector")


@register("learned_quality")
def learned_quality(spark, sf_dir):
    """Per entity, over the held-out documents: spans of the detectors, spans found, and those equal in place and entity."""
    rows, spec = fitted(spark, sf_dir)
    found = N.detect_ner(rows.where("held_out"), "text", spec)
    place = lambda x: F.struct(x["start"], x["end"], x["entity"])
    found = found.withColumn("__found", F.transform("ner", place))
    mark = lambda g, f: lambda x: F.struct(
        x["entity"].alias("entity"), F.lit(g).alias("g"), F.lit(f).alias("f"),
        (F.array_contains("__found", place(x)) if g else F.lit(False)).cast("int").alias("r"))
    spans = found.select(F.inline_outer(F.concat(F.transform("gold", mark(1, 0)), F.transform("ner", mark(0, 1)))))
    return spans.where("entity IS NOT NULL").groupBy("entity").agg(
        F.sum("g").alias("n_gold"), F.sum("f").alias("n_found"), F.sum("r").alias("n_right"))

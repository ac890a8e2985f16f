"""Redaction: R4 apply, R5 residual check, R1/R2 normalise and gate saved input.

R4 is one narrow projection: text and spans sit on the same row, so the
rewrite needs no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.functions import spans as S

STYLES = ("label", "mask", "drop")


def apply_redactions(df: DataFrame, text_col: str = "text", spans_col: str = "findings",
                     style: str = "label", out: str = "redacted_text",
                     merged: bool = False, stable: bool = False, patterns=P.DEFAULT) -> DataFrame:
    """Replace every span.  Spans are merged first unless ``merged``,
    because replacing overlapping spans one by one could leave part visible.

    ``stable``: dropping joins the two sides of a span, which may form a new finding of
    ``patterns``; such texts are labelled instead (a label's brackets are in no pattern)."""
    if isinstance(style, str) and style not in STYLES and style not in df.columns:
        raise ValueError(f"style must be one of {STYLES} or a column holding one")
    spans = S.ref(spans_col) if merged else S.merge_spans(S.ref(spans_col))
    redact = lambda sql: F.expr(S.redact_text(S.ref(text_col), spans, sql))
    done = df.withColumn(out, redact(S.style_sql(style)))
    if not stable or style in ("label", "mask"):
        return done
    dropped = F.lit(True) if style == "drop" else F.col(style) == "drop"
    labelled = redact(S.lit("label"))
    anew = F.lit(False)
    for p in P.validate(patterns):
        anew = anew | (F.regexp_count(F.col(out), F.lit(p.scanned)) > F.regexp_count(F.col("__labelled"), F.lit(p.scanned)))
    some = F.size(F.coalesce(F.col(spans_col), F.array())) > 0
    done = done.withColumn("__labelled", F.when(dropped & some, labelled))
    return done.withColumn(out, F.when(dropped & some & anew, F.col("__labelled")).otherwise(F.col(out))).drop("__labelled")


def residual_check(redacted: DataFrame, text_cols=("redacted_text",), patterns=P.DEFAULT) -> DataFrame:
    """Detection rerun on the output columns, counted per entity (all expected 0).

    Several outputs of one row (e.g. one per style) are scanned side by side on
    the array plane.  Every entity is listed, also with ``n = 0``: the counts
    come from one global aggregate (partial per task) and are then unpivoted.
    """
    from shroud.operators.detect import detect_patterns

    pats = P.validate(patterns)
    cols = [text_cols] if isinstance(text_cols, str) else list(text_cols)
    found = redacted.select(*cols)
    outs = []
    for i, c in enumerate(cols):
        found = detect_patterns(found, c, pats, out=f"__r{i}")
        outs.append(F.col(f"__r{i}"))
    ent = F.explode_outer(F.concat(*outs) if len(outs) > 1 else outs[0]).alias("f")  # no inferred filter
    counts = found.select(ent).agg(*[
        F.count_if(F.col("f.entity") == p.entity).alias(p.entity) for p in pats])
    stack = ", ".join(f"'{p.entity}', `{p.entity}`" for p in pats)
    return counts.selectExpr(f"stack({len(pats)}, {stack}) as (entity, n)")

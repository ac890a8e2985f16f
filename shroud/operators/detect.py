"""Detection: D1 patterns, D6 union, D8 detection result, D9 count, D10 profile.

A detector is a function ``(DataFrame, text column) -> DataFrame`` that adds
(or extends) an ``array<finding>`` column on the same row as the text.  The
text never crosses a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.functions import spans as S
from shroud.functions.spans import FINDING_DDL, empty, ref, regex_matches


def _append(df: DataFrame, out: str, new_sql: str) -> Column:
    if out in df.columns:
        return F.expr(f"concat(coalesce({ref(out)}, {empty(FINDING_DDL)}), {new_sql})")
    return F.expr(new_sql)


def detect_patterns(df: DataFrame, text_col: str = "text", patterns=P.DEFAULT,
                    out: str = "findings", enabled: Column | None = None) -> DataFrame:
    """Every match of every pattern, with code-point offsets.

    One scan per pattern collects the matches in their own projection (so it is not
    repeated); offsets are then computed from them.  Texts that miss a pattern's literal
    or gate aren't scanned for it.  Time is linear in the text, whatever it holds.
    ``enabled`` (a boolean column, D5) switches the detector off per row.
    """
    pats = P.validate(patterns)
    if not pats:
        return df.withColumn(out, _append(df, out, empty(FINDING_DDL)))
    text = F.col(text_col)
    mcols = [f"__m{i}" for i in range(len(pats))]
    src = text if enabled is None else F.when(enabled, text)
    gates = {g: f"__g{i}" for i, g in enumerate(sorted({p.gate for p in pats if p.gate}))}

    def scan(p):
        m = regex_matches(src, p.scanned)
        for test in ([F.col(gates[p.gate])] if p.gate else []) + ([F.instr(src, p.required) > 0] if p.required else []):
            m = F.when(test, m)
        return m

    gated = df.select("*", *[src.rlike(g).alias(c) for g, c in gates.items()]) if gates else df
    staged = gated.select(*df.columns, *[scan(p).alias(c) for p, c in zip(pats, mcols)])
    found = [S.to_findings(S.find_all(ref(text_col), ref(c), p.scanned, p.check), p.entity) for p, c in zip(pats, mcols)]
    new = f"concat({', '.join(found)})" if len(found) > 1 else found[0]
    keep = [F.col(c) for c in df.columns if c != out]
    return staged.select(*keep, _append(df, out, new).alias(out))


def union_findings(df: DataFrame, cols, out: str = "findings") -> DataFrame:
    """D6 on the array plane: the detectors' arrays end in one array."""
    arrays = [f"coalesce({ref(c)}, {empty(FINDING_DDL)})" for c in cols]
    return df.withColumn(out, F.expr(f"concat({', '.join(arrays)})" if len(arrays) > 1 else arrays[0]))


def union_tables(*tables: DataFrame) -> DataFrame:
    """D6 on the table plane."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def merge(df: DataFrame, col: str = "findings", out: str | None = None) -> DataFrame:
    """D7 on the array plane (see ``merge_spans``)."""
    return df.withColumn(out or col, F.expr(S.merge_spans(ref(col))))


def explode_findings(df: DataFrame, keys, col: str = "findings", with_score: bool = False) -> DataFrame:
    """Table plane: one row per finding, ``end`` renamed ``end_`` (a keyword elsewhere).

    ``inline_outer`` plus a filter on its output: a plain ``inline`` makes
    Catalyst infer ``size(findings) > 0`` and push it (with the whole detection
    expression) below any repartition, into the scan task."""
    cols = [F.col(k) for k in keys]
    out = df.select(*cols, F.inline_outer(F.col(col))).where(F.col("start").isNotNull())
    sel = [*keys, "start", F.col("end").alias("end_"), "entity", "detector"]
    if with_score:
        sel.append("score")
    return out.select(*sel)


def findings_json(col: str = "findings") -> Column:
    """Fixed field order, so the JSON text is comparable across engines."""
    return F.to_json(F.transform(F.col(col), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["entity"].alias("entity"),
        x["detector"].alias("detector"))))


def redaction_count(df: DataFrame, col: str = "findings", out: str = "n_redactions") -> DataFrame:
    """``size``; an absent array stays null (strict clients)."""
    return df.withColumn(out, F.size(F.col(col)))


def detection_result(df: DataFrame, key: str, col: str = "findings") -> DataFrame:
    """D8, the findings part: one record per document with its redactions (:func:`detection_response` has the rest).

    Every document keeps its row (findings ride on the row, so nothing is
    lost to an inner join); a document with nothing found has ``[]``.
    """
    return df.select(
        F.col(key), F.size(F.col(col)).alias("n_redactions"),
        findings_json(col).alias("redactions_json"))


def detection_response(df: DataFrame, key: str, text_col: str = "text", col: str = "findings") -> DataFrame:
    """D8, the whole response: job id and status, the output file that the redaction asks for, the redactions.

    A null text is an ``error`` response without output files and without redactions, never an empty result."""
    bad = F.col(text_col).isNull()
    ident = F.col(key).cast("string")
    fdf = F.struct(F.lit("fdf").alias("fileCode"), F.concat(F.lit("fdf-"), ident).alias("fileId"))
    return df.select(
        F.concat(F.lit("detect-"), ident).alias("job_id"), F.when(bad, "error").otherwise("finished").alias("status"),
        F.when(bad, F.array().cast("array<struct<fileCode:string,fileId:string>>")).otherwise(F.array(fdf)).alias("output_files"),
        F.when(~bad, F.size(col)).alias("n_redactions"), F.when(~bad, findings_json(col)).alias("redactions_json"),
        F.when(bad, "no text").alias("error"))


def entity_profile(findings_table: DataFrame, key: str = "doc_id", by: str = "lang") -> DataFrame:
    """Findings by entity x ``by``, with totals per entity (``rollup``).

    ``by`` rides on the findings rows (it sits on the document row before the
    explode), so no join is needed.  Findings are first reduced to one row per
    (key, entity), so ``n_docs`` is a plain count, not a distinct aggregation.
    """
    per_doc = findings_table.groupBy(key, by, "entity").agg(F.count(F.lit(1)).alias("n"))
    return (per_doc.rollup("entity", by)
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("entity").isNotNull())
            .select("entity", F.coalesce(F.col(by), F.lit("*")).alias(by), "n", "n_docs"))

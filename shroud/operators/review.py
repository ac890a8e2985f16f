"""Human review: H1 review queue, H2 apply decisions, H3 review outcome.

Decisions (M11): doc_id, start, end, action (accept / reject / add), entity,
reviewer, decided_at.  Only the latest decision per span counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shroud.functions import spans as S

ACTIONS = ("accept", "reject", "add")


def latest_decisions(decisions: DataFrame) -> DataFrame:
    """One row per (doc_id, start, end): the latest decision (ties by action name).
    ``max_by`` combines partially per task, so a busy document is no hotspot."""
    pick = F.max_by(F.struct("action", "entity", "reviewer", "decided_at"), F.struct("decided_at", "action"))
    return (decisions.groupBy("doc_id", "start", "end").agg(pick.alias("d"))
            .select("doc_id", "start", "end", "d.action", "d.entity", "d.reviewer", "d.decided_at"))


def decisions_per_doc(decisions: DataFrame) -> DataFrame:
    """Latest decisions as one small array per document, ready to ride on the document row."""
    latest = latest_decisions(decisions)
    return latest.groupBy("doc_id").agg(F.collect_list(F.struct(
        "start", "end", "action", "entity")).alias("decisions"))


def apply_decisions_array(findings: str, decisions: str) -> Column:
    """H2 on the array plane (column names): rejected spans leave, added spans
    join, the rest stay; the result is merged again (D7), sorted by start."""
    return F.expr(S.apply_decisions(S.ref(findings), S.ref(decisions)))


def apply_decisions(docs: DataFrame, decisions: DataFrame, findings_col: str = "findings",
                    key: str = "doc_id") -> DataFrame:
    """H2: the per-document decision arrays are left-joined to the document
    rows (documents without decisions keep their findings), then applied on
    the row.  Only the small decision arrays are grouped; the findings and the
    text stay where they are."""
    per_doc = decisions_per_doc(decisions).withColumnRenamed("doc_id", key)
    joined = docs.join(per_doc, key, "left")
    return joined.withColumn(findings_col, apply_decisions_array(findings_col, "decisions")).drop("decisions")


def review_outcome(findings_rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """H3: accepted / rejected / added / open per detector.

    ``findings_rows``: doc_id, start, end_, detector.  A full outer join on the
    span keeps findings without decision (open) and decisions without finding
    (adds); counting is a partial aggregation per detector.
    """
    latest = latest_decisions(decisions).select("doc_id", "start", F.col("end").alias("end_"), "action")
    j = findings_rows.select("doc_id", "start", "end_", "detector").join(
        latest, ["doc_id", "start", "end_"], "full_outer")
    det = F.when(F.col("action") == "add", F.lit("review")).otherwise(F.col("detector"))
    a = F.col("action")
    return (j.where(F.col("detector").isNotNull() | (a == "add"))
            .groupBy(det.alias("detector")).agg(
                F.count_if(F.col("detector").isNotNull() & (a == "accept")).alias("accepted"),
                F.count_if(F.col("detector").isNotNull() & (a == "reject")).alias("rejected"),
                F.count_if(a == "add").alias("added"),
                F.count_if(F.col("detector").isNotNull() & a.isNull()).alias("open")))


def review_queue(docs: DataFrame, k: int, findings_col: str = "findings", text_col: str = "text",
                 group: str = "source", key: str = "doc_id", context: int = 20) -> DataFrame:
    """H1: the ``k`` documents per ``group`` with the most findings, with a
    snippet around the first finding, cut from the redacted text.

    ``row_number() <= k`` lets Spark insert a per-partition group limit before
    the shuffle, so a huge group ships at most ``k`` rows per task.
    """
    f = F.get(F.col(findings_col), 0)
    # cut from the redacted text: before the first finding both texts are the same
    start = F.greatest(f["start"] - context, F.lit(0))
    docs = docs.withColumn("__redacted", F.when(F.size(findings_col) > 0, F.expr(S.redact_text(S.ref(text_col), S.ref(findings_col)))))
    snippet = F.col("__redacted").substr(start + 1, f["start"] - start + F.length(f["entity"]) + 2 + context)
    cand = docs.select(group, key, F.size(findings_col).alias("n"), snippet.alias("snippet"))
    w = Window.partitionBy(group).orderBy(F.col("n").desc(), F.col(key))
    # documents without findings rank last, so dropping them after ranking
    # changes no rank, and no filter on the detection output is pushed into
    # the scan (where it would run the detection before the work is spread)
    return (cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .where(F.col("n") > 0).select(group, "rank", key, "n", "snippet"))

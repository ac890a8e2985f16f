"""T1 async detection, T2 job tracker, T3 token uses within TTL, T4 re-delivery dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.operators import detect as D
from shroud.operators.protect import token_use_pairs
from shroud.sources.events import TERMINAL

JOB_DEADLINE_S = 3600


def detect_stream(docs: DataFrame, key: str = "doc_id", text_col: str = "text", patterns=P.DEFAULT) -> DataFrame:
    """The batch detection (D1 + D7) applied per micro-batch; stateless,
    so every input row is answered exactly once and equals the batch result."""
    return D.explode_findings(D.merge(D.detect_patterns(docs, text_col, patterns)), [key])


def dedup_stream(requests: DataFrame, key: str = "event_id", ts: str = "ts",
                 delay: str = "1 hour") -> DataFrame:
    """T4: a request delivered again within the watermark delay is dropped."""
    return requests.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def token_uses_stream(issues: DataFrame, uses: DataFrame, ttl_minutes: int = 1440,
                      delay: str = "10 minutes") -> DataFrame:
    """Stream-stream interval join (``latest_issue`` reduces its sink to one row per use); both sides carry a watermark and the
    join has a time range, so join state is dropped once the watermark passes
    the end of an issue's validity."""
    return token_use_pairs(issues.withWatermark("ts", delay), uses.withWatermark("ts", delay), ttl_minutes)


TRACKER_WINDOW = "1 hour"


def _terminal():
    return F.when(F.col("status").isin(*TERMINAL), F.struct("ts", "event_id", "status"))


def job_tracker_stream(job_events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """T2, streaming half: per job and time window the first event and the first terminal
    event (``update`` mode: a window's row is written again when it improves).

    Built-in aggregation: partial sums per task (a hot job is no hotspot), and a
    window's state goes when the watermark passes its end, however far that jumps."""
    return (job_events.withWatermark("ts", delay).groupBy("job_id", F.window("ts", TRACKER_WINDOW))
            .agg(F.min("ts").alias("t0"), F.min(_terminal()).alias("term"))
            .select("job_id", "t0", "term"))


def job_outcomes(partials: DataFrame) -> DataFrame:
    """T2, outcome: exactly one row per job (finished / error / timeout) from all partial
    rows written so far.  Minima don't mind rows written twice or superseded ones."""
    agg = partials.groupBy("job_id").agg(F.min("t0").alias("t0"), F.min("term").alias("term"))
    deadline = F.col("t0") + F.expr(f"INTERVAL {JOB_DEADLINE_S} SECONDS")
    in_time = F.col("term").isNotNull() & (F.col("term.ts") <= deadline)
    return agg.select("job_id", F.when(in_time, F.col("term.status")).otherwise(F.lit("timeout")).alias("status"),
                      F.when(in_time, F.col("term.ts")).otherwise(deadline).alias("ts"))


def job_tracker_batch(job_events: DataFrame) -> DataFrame:
    """The batch form of T2 over all events (for equality checks)."""
    return job_outcomes(job_events.select("job_id", F.col("ts").alias("t0"), _terminal().alias("term")))


__all__ = ["detect_stream", "dedup_stream", "token_uses_stream", "job_tracker_stream", "job_outcomes", "job_tracker_batch"]

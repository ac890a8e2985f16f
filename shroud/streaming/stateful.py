"""Streams with keyed state and event-time timers: job outcomes (T2) and token uses.

Both keep a bounded state per key and give results out of the stream itself.  They need
the RocksDB state store (``runner.run_available(..., rocksdb=True)`` selects it for its query).
Times travel as microseconds, so no time zone or float rounding touches them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from shroud.sources.events import TERMINAL

NEVER = 2**63 - 1  # "no such time" in the state


def _ms(us: int) -> int:
    """The first millisecond not before a time in microseconds (timers count in milliseconds)."""
    return -(-us // 1000)


# ---- T2 ----
def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per job and Arrow batch: its first event, first terminal event and last event time.
    A job that holds a third of all events so sends a few rows per task to its state."""
    for b in batches:
        t = pa.Table.from_batches([b])
        ended = t.filter(pc.is_in(t["status"], pa.array(TERMINAL))).sort_by([("us", "ascending"), ("event_id", "ascending")])
        first = ended.group_by("job_id", use_threads=False).aggregate([("us", "first"), ("event_id", "first"), ("status", "first")])
        span = t.group_by("job_id").aggregate([("us", "min"), ("ts", "max")])
        j = span.join(first, "job_id", join_type="left outer")
        yield from pa.table({
            "job_id": j["job_id"], "t0": j["us_min"], "ts": j["ts_max"],
            "term_us": pc.fill_null(j["us_first"], NEVER), "term_id": pc.fill_null(j["event_id_first"], NEVER),
            "term_status": pc.fill_null(j["status_first"], "")}).to_batches()


class JobOutcome(StatefulProcessor):
    """State of a job: first event, first terminal event, the timer set, and whether the outcome was given."""

    def __init__(self, deadline_s: int):
        self.limit = deadline_s * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "t0 long, term_us long, term_id long, term_status string, timer long, done boolean")

    def _outcome(self, t0: int, term_us: int, status: str) -> tuple[str, int]:
        return (status, term_us) if term_us <= t0 + self.limit else ("timeout", t0 + self.limit)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        t0, term_us, term_id, status, timer, done = self.job.get() if self.job.exists() else (NEVER, NEVER, NEVER, "", -1, False)
        for f in rows:
            t0 = min(t0, int(f["t0"].min()))
            term_us, term_id, status = min((term_us, term_id, status), min(
                zip(f["term_us"].tolist(), f["term_id"].tolist(), f["term_status"].tolist(), strict=True)))
        if not done:
            due = _ms(self._outcome(t0, term_us, status)[1])
            if due != timer:
                if timer >= 0:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
            self.job.update((t0, term_us, term_id, status, due, False))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t0, term_us, term_id, status, timer, done = self.job.get()
        if not done:
            self.job.update((t0, term_us, term_id, status, timer, True))
            outcome, us = self._outcome(t0, term_us, status)
            yield pd.DataFrame({"job_id": [key[0]], "status": [outcome], "us": [us]})

    def close(self) -> None:
        pass


def job_outcome_stream(job_events: DataFrame, deadline_s: int, delay: str = "10 minutes") -> DataFrame:
    """One row per job (``finished``, ``error`` or ``timeout``), once the watermark has passed the
    time of the outcome, so a late event can't change it.  Events with a null job or time have no job."""
    e = job_events.where(F.col("job_id").isNotNull() & F.col("ts").isNotNull()).withColumn("us", F.unix_micros("ts"))
    job_type = e.schema["job_id"].dataType.simpleString()
    per = e.select("job_id", "event_id", "ts", "status", "us").mapInArrow(
        _combine, f"job_id {job_type}, t0 long, ts timestamp, term_us long, term_id long, term_status string")
    out = per.withWatermark("ts", delay).groupBy("job_id").transformWithStateInPandas(
        JobOutcome(deadline_s), f"job_id {job_type}, status string, us long", "Append", "EventTime")
    return out.select("job_id", "status", F.timestamp_micros("us").alias("ts"))


# ---- T3 ----
NO_ID = -2**63  # a null event id on its way through the state
#: Users are dealt over so many groups; a state holds the users of one group and one bucket.
GROUPS = 64
ROW = ["user_id", "us", "event_id", "is_use", "answered", "is_open"]


def _answer(t: pd.DataFrame, ttl_us: int, passed: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """New answers and the rows that may still matter, of the issues and uses of one group and bucket.

    A use is answered by its user's latest issue not after it (of equal times the largest id)."""
    code = pd.factorize(t["user_id"])[0]
    order = np.lexsort((t["event_id"], t["is_use"], t["us"], code))  # issues stand before the uses of their time
    t, code = t.iloc[order].reset_index(drop=True), code[order]
    us, ident, is_use, answered, is_open = (t[c].to_numpy() for c in ROW[1:])
    at = np.maximum.accumulate(np.where(is_use, -1, np.arange(len(t))))
    met = is_use & (at >= 0) & (code[at] == code) & (us - us[at] <= ttl_us) & (is_open | (ident[at] != answered))
    by = at[met]
    out = pd.DataFrame({"issue_id": ident[by], "use_id": ident[met], "user_id": t["user_id"].to_numpy()[met],
                        "use_us": us[met], "issue_us": us[by]})
    t["answered"], t["is_open"] = np.where(met, ident[at], answered), is_open & ~met
    # behind the watermark no use and no issue comes any more: of a user's issues there only the last one counts
    old = us <= passed
    issues = np.flatnonzero(~is_use)
    late = issues[1:][(code[issues[1:]] == code[issues[:-1]]) & old[issues[1:]]]
    keep = ~(old & is_use)
    keep[issues[np.searchsorted(issues, late) - 1]] = False
    return out, t[keep]


class LatestIssue(StatefulProcessor):
    """State of (group of users, bucket): of every user the latest issue behind the watermark, and what lies before it
    (issues that may still come out of order, uses that such an issue may still change), as one Arrow table."""

    def __init__(self, ttl_us: int, width_us: int):
        self.ttl, self.width = ttl_us, width_us

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        parts = [f[ROW[:4]].assign(answered=NO_ID, is_open=True) for f in rows]
        if self.seen.exists():
            parts.insert(0, pa.ipc.open_stream(self.seen.get()[0]).read_all().to_pandas())
        else:
            self.handle.registerTimer(_ms((key[1] + 1) * self.width))
        out, kept = _answer(pd.concat(parts, ignore_index=True), self.ttl, passed)
        buffer = pa.BufferOutputStream()
        table = pa.Table.from_pandas(kept, preserve_index=False)
        with pa.ipc.new_stream(buffer, table.schema) as w:
            w.write_table(table)
        self.seen.update((buffer.getvalue().to_pybytes(),))
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def token_answers_stream(issues: DataFrame, uses: DataFrame, ttl_minutes: int = 1440, delay: str = "10 minutes",
                         parts: int = 4, groups: int = GROUPS) -> DataFrame:
    """Every use of a live token once, with its latest issue, as soon as it arrives; a row follows again only
    when an issue that came late is the better answer (``protect.latest_issue`` keeps the best).

    Time is cut into buckets of a ``parts``-th of the TTL; an issue goes to its own and the next
    ``parts`` buckets, a use to its own.  A busy user's day so spreads over buckets, and
    a bucket's state goes when the watermark passes its end.  A state (with its calls between Spark and Python, a few
    milliseconds each) is one per bucket and group of users, not per user; ``groups`` grows
    with the number of users at one time.  Event ids are integers."""
    ttl = ttl_minutes * 60_000_000
    width = ttl // parts
    us = F.unix_micros("ts")
    bucket = F.floor(us / F.lit(width)).cast("long")
    cols = [F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int").alias("grp"), "user_id",
            F.coalesce(F.col("event_id").cast("long"), F.lit(NO_ID)).alias("event_id"), "ts", us.alias("us")]
    i = issues.select(*cols, F.lit(False).alias("is_use"), F.explode(F.sequence(bucket, bucket + parts)).alias("bucket"))
    u = uses.select(*cols, F.lit(True).alias("is_use"), bucket.alias("bucket"))
    both = i.unionByName(u).where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).withWatermark("ts", delay)
    user = both.schema["user_id"].dataType.simpleString()
    out = both.groupBy("grp", "bucket").transformWithStateInPandas(
        LatestIssue(ttl, width), f"issue_id long, use_id long, user_id {user}, use_us long, issue_us long", "Update", "EventTime")
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return out.select(known("issue_id"), known("use_id"), "user_id", F.timestamp_micros("issue_us").alias("issue_ts"),
                      F.timestamp_micros("use_us").alias("use_ts"))

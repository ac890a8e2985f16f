"""Job records: J1-J12 and the redaction input contract R1-R3, R6.

Responses are parsed once into a VARIANT (``try_parse_json``); every field is
then a cheap ``try_variant_get``.  Per-job questions (latest state, first and
final answer, poll counts) are aggregations with partial (map-side) combine,
so one job holding a third of all events still spreads over every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.sources.events import TERMINAL

MODES = ("sync", "async")
FILES_T = "array<struct<fileCode:string,fileId:string,dekToken:string>>"
PLAIN_TIMEOUT_S = 120      # per plain request (upload, download, poll, accepting an async job)
JOB_TIMEOUT_S = 3600       # per job, and per request that waits for its job (mode ``sync``)


# ---- F-helpers over a parsed response ----
def parsed(json_col: Column) -> Column:
    return F.try_parse_json(json_col)


def vget(v: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, path, typ)


def output_file(v: Column, code: str) -> Column:
    """First output file with ``code``; a null list counts as empty."""
    files = F.coalesce(vget(v, "$.outputFiles", FILES_T), F.array().cast(FILES_T))
    return F.get(F.filter(files, lambda x: x["fileCode"] == F.lit(code)), 0)


def job_failed(v: Column) -> Column:
    """Status ``error``, or ``error`` an object with at least one property."""
    err = vget(v, "$.error", "map<string,variant>")
    return vget(v, "$.jobStatus").eqNullSafe(F.lit("error")) | F.coalesce(F.size(err) > 0, F.lit(False))


def error_message(v: Column, stage: str) -> Column:
    """Title (or ``<stage> job failed.``), then ``Detail:`` and ``TraceId:`` parts."""
    title = vget(v, "$.error.title")
    detail = vget(v, "$.error.detail")
    trace = vget(v, "$.error.traceId")
    return F.concat_ws(" ",
                       F.coalesce(F.nullif(title, F.lit("")), F.lit(f"{stage} job failed.")),
                       F.when(detail != "", F.concat(F.lit("Detail: "), detail)),
                       F.when(trace != "", F.concat(F.lit("TraceId: "), trace)))


def shell_failed(v: Column) -> Column:
    """The shell clients' rule (J9 only): status error or any error text non-empty."""
    parts = [vget(v, f"$.error.{f}") for f in ("title", "detail", "traceId")]
    any_text = F.lit(False)
    for p in parts:
        any_text = any_text | F.coalesce(p != "", F.lit(False))
    return vget(v, "$.jobStatus").eqNullSafe(F.lit("error")) | any_text


def outcome_class(http: Column, v: Column) -> Column:
    """202 in progress; 200 and failed; 200 finished; anything else unexpected."""
    return (F.when(http == 202, F.lit("inProgress"))
            .when((http == 200) & shell_failed(v), F.lit("failed"))
            .when(http == 200, F.lit("finished"))
            .otherwise(F.lit("unexpected")))


def redactions_array(v: Column) -> Column:
    """``result.redactions`` as a VARIANT array, or null when missing (R2)."""
    r = vget(v, "$.result.redactions", "variant")
    return F.when(F.schema_of_variant(r).startswith("ARRAY"), r)


def variant_size(arr: Column) -> Column:
    return F.size(F.try_variant_get(arr, "$", "array<variant>"))


def job_summary(responses: DataFrame) -> DataFrame:
    """One flat row per response; the token is reported as present or not, never by value."""
    v = parsed(F.col("json"))
    fdf, pdf = output_file(v, "fdf"), output_file(v, "pdf")
    return responses.select(
        F.col("event_id").alias("case_id"), vget(v, "$.jobId").alias("job_id"),
        vget(v, "$.jobStatus").alias("status"),
        vget(v, "$.error.title").alias("error_title"), vget(v, "$.error.detail").alias("error_detail"),
        vget(v, "$.error.traceId").alias("error_trace_id"),
        fdf["fileId"].alias("fdf_file_id"), pdf["fileId"].alias("pdf_file_id"),
        F.coalesce(fdf["dekToken"] != "", F.lit(False)).alias("token_present"),
        variant_size(redactions_array(v)).alias("n_redactions"))


def token_carry(responses: DataFrame, code: str = "fdf") -> DataFrame:
    """J5 per job: the output reference (with its token) comes from the first
    answer if it has one, else from the final answer (J3) -- the whole struct,
    so a token is never paired with another answer's file.  Output: job_id,
    {code}_file_id, token_present (never the token itself).
    responses: job_id, ts, event_id, json."""
    v = parsed(F.col("json"))
    per = responses.select("job_id", "ts", "event_id", vget(v, "$.jobStatus").alias("status"),
                           output_file(v, code).alias("ref"))
    key = F.struct("ts", "event_id")
    agg = per.groupBy("job_id").agg(F.min_by(F.struct("status", "ref"), key).alias("first"),
                                    F.max_by(F.struct("status", "ref"), key).alias("last"))
    final_ref = F.when(F.col("first.status") == "inProgress", F.col("last.ref")).otherwise(F.col("first.ref"))
    carry = F.coalesce(F.col("first.ref"), final_ref)
    return agg.select("job_id", carry["fileId"].alias(f"{code}_file_id"),
                      F.coalesce(carry["dekToken"] != "", F.lit(False)).alias("token_present"))


# ---- R1 / R2 ----
def _saved_array(json_col: str) -> tuple[Column, Column]:
    """The saved redactions (VARIANT) and whether they are an array: an object gives
    ``result.redactions`` if present and not null, else ``redactions``; any other root
    is taken as is."""
    v = F.try_parse_json(F.col(json_col))
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    inner = vget(v, "$.result.redactions", "variant")
    inner_ok = inner.isNotNull() & ~F.coalesce(F.is_variant_null(inner), F.lit(True))
    picked = F.when(is_obj, F.when(inner_ok, inner).otherwise(vget(v, "$.redactions", "variant"))) \
        .otherwise(v)
    return picked, F.coalesce(F.schema_of_variant(picked).startswith("ARRAY"), F.lit(False))


def normalize_redactions(saved: DataFrame) -> DataFrame:
    """R1.  Output: case_id, n, is_error (no array, or broken JSON) and the array itself:
    ``redactions`` as spans with null where a field is missing or of another type."""
    picked, is_arr = _saved_array("json")
    items = F.try_variant_get(picked, "$", "array<variant>")
    item = lambda x: F.struct(
        vget(x, "$.start", "int").alias("start"), vget(x, "$.end", "int").alias("end"), vget(x, "$.entity", "string").alias("entity"),
        F.coalesce(vget(x, "$.detector", "string"), F.lit("review")).alias("detector"),
        F.coalesce(vget(x, "$.score", "double"), F.lit(1.0)).alias("score"))
    return saved.select("case_id", F.when(is_arr, variant_size(picked)).alias("n"), (~is_arr).alias("is_error"),
                        F.when(is_arr, F.transform(items, item)).alias("redactions"))


def redact_from_saved(docs: DataFrame, saved: DataFrame, key: str = "doc_id", text_col: str = "text", style: str = "label") -> DataFrame:
    """R1 -> R2 -> R4: texts redacted by saved (or edited) redactions, ``saved(case_id, json)``.

    Every document keeps its row.  No array is a refusal, and so is one span without offsets or entity, or
    outside its text (``reason``; no redacted text).  An empty array proceeds: the text unchanged."""
    from shroud.functions import spans as S

    norm = normalize_redactions(saved).withColumnRenamed("case_id", "__case")
    j = docs.join(norm, F.col(key) == F.col("__case"), "left")
    good = F.forall("redactions", lambda x: F.coalesce(
        (x["start"] >= 0) & (x["end"] > x["start"]) & (x["end"] <= F.length(text_col)) & x["entity"].isNotNull(), F.lit(False)))
    reason = (F.when(F.col(text_col).isNull(), F.lit("no text"))
              .when(F.col("redactions").isNull(), F.lit("no redactions"))
              .when(~F.coalesce(good, F.lit(False)), F.lit("invalid span")))
    merged = j.withColumn("reason", reason).withColumn("redactions", F.expr(
        f"CASE WHEN reason IS NULL THEN {S.merge_spans('redactions')} END"))
    out = F.when(F.col("reason").isNull(), F.expr(S.redact_text(S.ref(text_col), "redactions", S.style_sql(style))))
    return merged.select(key, F.when(F.col("reason").isNull(), F.size("redactions")).alias("n_redactions"), out.alias("redacted_text"), "reason")


def redaction_gate(responses: DataFrame) -> DataFrame:
    """R2: a missing array fails; an empty one proceeds (and changes nothing)."""
    v = parsed(F.col("json"))
    arr = redactions_array(v)
    return responses.select(F.col("event_id").alias("case_id"), variant_size(arr).alias("n"),
                            arr.isNull().alias("is_error"))


# ---- J1 ----
def mode_validation(requests: DataFrame, mode_col: str = "mode") -> DataFrame:
    """``sync`` / ``async`` accepted, anything else quarantined with a reason
    (a row, not an exception, so one bad request does not fail a batch)."""
    m = F.col(mode_col)
    return requests.withColumn("valid", F.coalesce(m.isin(*MODES), F.lit(False))) \
        .withColumn("reason", F.when(~F.col("valid"), F.concat(F.lit("processing mode must be 'sync' or 'async': "),
                                                                 F.coalesce(m, F.lit("null")))))


# ---- J2, J3, J10, J11 over job events ----
def job_latest(job_events: DataFrame) -> DataFrame:
    """What a poll returns now: the latest event per job (ties by event id)."""
    latest = F.max_by(F.struct("status", "ts"), F.struct("ts", "event_id"))
    return job_events.groupBy("job_id").agg(latest.alias("l")).select("job_id", "l.status", "l.ts")


def first_and_last(job_events: DataFrame) -> DataFrame:
    """One aggregation gives the initial answer, the latest one, the first
    terminal event and the event count per job."""
    key = F.struct("ts", "event_id")
    terminal = F.col("status").isin(*TERMINAL)
    return job_events.groupBy("job_id").agg(
        F.min_by(F.struct("status", "ts"), key).alias("first"),
        F.max_by(F.struct("status", "ts"), key).alias("last"),
        F.min(F.when(terminal, key)).alias("term"))


def resolve_response(job_events: DataFrame) -> DataFrame:
    """An ``inProgress`` first answer is replaced by the polled (latest) one."""
    fl = first_and_last(job_events)
    final = F.when(F.col("first.status") == "inProgress", F.col("last.status")).otherwise(F.col("first.status"))
    return fl.select("job_id", final.alias("final_status"))


def job_timeouts(job_events: DataFrame, as_of: Column, limit_s: int = JOB_TIMEOUT_S) -> DataFrame:
    """Seconds from submission to the first terminal event (or to ``as_of``)."""
    if not isinstance(limit_s, int) or limit_s <= 0:
        raise ValueError("timeout must be a positive integer")
    fl = first_and_last(job_events)
    end = F.coalesce(F.col("term.ts"), as_of)
    secs = F.timestamp_diff("SECOND", F.col("first.ts"), end)
    return fl.select("job_id", secs.alias("seconds"), (secs > limit_s).alias("timed_out"))


def request_timeouts(requests: DataFrame, as_of: Column) -> DataFrame:
    """J10 per request: ``case_id, kind, seconds, limit_s, timed_out``.  A request without an answer is judged at
    ``as_of``; a kind that is null or unknown has the plain limit; without a start nothing is known (null).

    requests: case_id, kind, started, ended."""
    limit = F.when(F.col("kind") == "sync", F.lit(JOB_TIMEOUT_S)).otherwise(F.lit(PLAIN_TIMEOUT_S))
    secs = F.timestamp_diff("SECOND", F.col("started"), F.coalesce(F.col("ended"), as_of))
    return requests.select("case_id", "kind", secs.alias("seconds"), limit.alias("limit_s"), (secs > limit).alias("timed_out"))


HOT_PARTS = 8     # a job's events meet its outcome in this many parts
SKETCH_K = 400    # KLL sketch size: normalised rank error below RANK_ERROR with over 99 % probability
RANK_ERROR = 0.02


def _polls(job_events: DataFrame) -> DataFrame:
    """job_id, f_ts, polls, seconds of every job with a terminal event.

    The outcome per job (one narrow row) is dealt to ``HOT_PARTS`` parts of the job by event id, and polls are
    counted per part, then per job: a job with a third of all events is counted by that many tasks.
    """
    parts = F.pmod(F.xxhash64("event_id"), F.lit(HOT_PARTS))
    fl = first_and_last(job_events).where(F.col("term").isNotNull()) \
        .select("job_id", F.col("term.ts").alias("t_ts"), F.col("term.event_id").alias("t_id"), F.col("first.ts").alias("f_ts"),
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(HOT_PARTS - 1).cast("bigint"))).alias("part"))
    e = job_events.select("job_id", "ts", "event_id", parts.alias("part"))
    upto = (F.col("ts") < F.col("t_ts")) | ((F.col("ts") == F.col("t_ts")) & (F.col("event_id") <= F.col("t_id")))
    per_part = e.join(fl, ["job_id", "part"], "inner").where(upto).groupBy("job_id", "part", "t_ts", "f_ts").agg(F.count(F.lit(1)).alias("n"))
    return per_part.groupBy("job_id", "t_ts", "f_ts").agg(F.sum("n").alias("polls")).select(
        "job_id", "f_ts", "polls", F.timestamp_diff("SECOND", F.col("f_ts"), F.col("t_ts")).alias("seconds"))


def poll_stats(job_events: DataFrame) -> DataFrame:
    """Polls up to and including the first terminal event, and seconds to it."""
    return _polls(job_events).select("job_id", "polls", "seconds")


def poll_sketches(job_events: DataFrame) -> DataFrame:
    """J11 summary to keep: one row per hour of submission with the number of jobs and a KLL sketch of polls
    and of seconds.  Rows of any hours merge (:func:`sketch_quantiles`) without the jobs being read again."""
    hourly = _polls(job_events).groupBy(F.date_trunc("hour", "f_ts").alias("hour"))
    return hourly.agg(F.count(F.lit(1)).alias("jobs"), F.kll_sketch_agg_bigint("polls", SKETCH_K).alias("polls"),
                      F.kll_sketch_agg_bigint("seconds", SKETCH_K).alias("seconds"))


def sketch_quantiles(sketches: DataFrame, ranks=(0.5, 0.9, 0.99)) -> DataFrame:
    """``measure, q, n, value`` from hourly sketches: values whose rank is within ``RANK_ERROR`` of q."""
    one = sketches.agg(F.sum("jobs").alias("n"), F.kll_merge_agg_bigint("polls", SKETCH_K).alias("polls"),
                       F.kll_merge_agg_bigint("seconds", SKETCH_K).alias("seconds")).where("n > 0")
    cells = [F.struct(F.lit(m).alias("measure"), F.lit(q).alias("q"), "n", F.kll_sketch_get_quantile_bigint(m, F.lit(q)).alias("value"))
             for m in ("polls", "seconds") for q in ranks]
    return one.select(F.inline(F.array(*cells)))


def rank_check(stats: DataFrame, quantiles: DataFrame) -> DataFrame:
    """The exact rank interval of every value against its q: ``measure, q, n, within``."""
    at = quantiles.agg(F.collect_list(F.struct("measure", "q", "value")).alias("at"))  # one row of a few cells
    long = stats.select(F.inline(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("bigint").alias("v")) for m in ("polls", "seconds")])))
    each = long.groupBy("m", "v").agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(at.select(F.inline("at"))), F.col("m") == F.col("measure"))
    ranks = each.groupBy("measure", "q").agg(F.sum("c").alias("n"), F.sum(F.when(F.col("v") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
                                             F.sum(F.when(F.col("v") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"))
    within = (F.col("below") <= (F.col("q") + RANK_ERROR) * F.col("n")) & (F.col("upto") >= (F.col("q") - RANK_ERROR) * F.col("n"))
    return ranks.select("measure", "q", "n", within.alias("within"))


def poll_percentiles(stats: DataFrame) -> DataFrame:
    """J11 summary: approximate quartiles of polls and seconds (rows-only check)."""
    return stats.agg(F.percentile_approx("polls", [0.5, 0.9]).alias("polls_p50_p90"),
                     F.percentile_approx("seconds", [0.5, 0.9]).alias("seconds_p50_p90"))


# ---- R3 / R6 ----
def redaction_requests(requests: DataFrame, files: DataFrame, annotations: DataFrame):
    """A request needs the document file and the annotation file, each with
    its own token.  Two left joins on (id, token) mark which of the two
    matched; accepted and refused rows (with the reason) then come from the
    same joined rows, so nothing is joined twice.

    requests: doc_id, pdf_file_id, pdf_token, fdf_file_id, fdf_token
    files / annotations: file_id, dek_token
    """
    f = files.select(F.col("file_id").alias("pdf_file_id"), F.col("dek_token").alias("pdf_token"),
                     F.lit(True).alias("pdf_ok"))
    a = annotations.select(F.col("file_id").alias("fdf_file_id"), F.col("dek_token").alias("fdf_token"),
                           F.lit(True).alias("fdf_ok"))
    j = requests.join(f, ["pdf_file_id", "pdf_token"], "left").join(a, ["fdf_file_id", "fdf_token"], "left")
    reason = (F.when(F.col("fdf_file_id").isNull() | F.col("fdf_token").isNull(), F.lit("annotation reference missing"))
              .when(F.col("pdf_ok").isNull(), F.lit("document token rejected"))
              .when(F.col("fdf_ok").isNull(), F.lit("annotation token rejected")))
    checked = j.select("doc_id", "pdf_file_id", "fdf_file_id", reason.alias("reason"))
    accepted = checked.where(F.col("reason").isNull()).select("doc_id", "pdf_file_id", "fdf_file_id")
    refused = checked.where(F.col("reason").isNotNull()).select("doc_id", "reason")
    return accepted, refused, checked


def redaction_result(checked: DataFrame) -> DataFrame:
    """A job record per request, from the checked requests in one pass;
    finished ones carry a ``pdf`` output, refused ones are ``error``."""
    ok = F.col("reason").isNull()
    return checked.select(F.concat(F.lit("redact-"), F.col("doc_id").cast("string")).alias("job_id"),
                          F.when(ok, F.lit("finished")).otherwise(F.lit("error")).alias("status"),
                          F.when(ok, F.concat(F.lit("red-"), F.col("pdf_file_id"))).alias("pdf_file_id"))

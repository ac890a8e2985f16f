"""Job records derived from the ``events`` table.

``events`` plays the broker's poll answers: one row per answer, the job is the
user.  The raw JSON response of every answer is rebuilt from the event with
``to_json`` (shapes vary with the event's ``props.k`` value, so every branch of
the job contract is exercised by real rows).  Tokens in these records are
placeholders, never real keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: mapping of event types to job states ----
STATUS_OF_EVENT = {"error": "error", "purchase": "finished"}  # anything else: inProgress
TERMINAL = ("finished", "error")
# ---- end of fixed values ----


def status_of(event_type: Column) -> Column:
    out = F.lit("inProgress")
    for ev, st in STATUS_OF_EVENT.items():
        out = F.when(event_type == ev, F.lit(st)).otherwise(out)
    return out


def job_events(events: DataFrame) -> DataFrame:
    """event_id, job_id, ts, status."""
    return events.select("event_id", F.col("user_id").alias("job_id"), "ts",
                         status_of(F.col("event_type")).alias("status"))


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def _file(code: str, fid: Column, token: Column | None) -> Column:
    tok = token if token is not None else F.lit(None).cast("string")
    return F.struct(F.lit(code).alias("fileCode"), fid.alias("fileId"), tok.alias("dekToken"))


def job_responses(events: DataFrame) -> DataFrame:
    """M4 rows: event_id, job_id, ts, http, json (the raw response body)."""
    e = events.select("event_id", "user_id", "ts", status_of(F.col("event_type")).alias("status"),
                      _k().alias("k"))
    eid = F.col("event_id").cast("string")
    st, k = F.col("status"), F.col("k")
    fdf1 = _file("fdf", F.concat(F.lit("fdf-"), eid),
                 F.when(k % 2 == 0, F.concat(F.lit("tk-"), eid)))
    fdf2 = _file("fdf", F.concat(F.lit("fdf2-"), eid), F.concat(F.lit("tk2-"), eid))
    pdf = _file("pdf", F.concat(F.lit("pdf-"), eid), F.concat(F.lit("tp-"), eid))
    initial_fdf = _file("fdf", F.concat(F.lit("fdf-j"), F.col("user_id").cast("string")),
                        F.concat(F.lit("tk-j"), F.col("user_id").cast("string")))
    files_t = "array<struct<fileCode:string,fileId:string,dekToken:string>>"
    outputs = (F.when(st == "finished", F.when(k % 4 == 3, F.array(fdf1, fdf2, pdf)).otherwise(F.array(fdf1, pdf)))
               .when(st == "error", F.array().cast(files_t))
               .when(k % 3 == 0, F.array(initial_fdf)))
    found = F.filter(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.struct(
        (i * 10).alias("start"), (i * 10 + 5).alias("end"), F.lit("email").alias("entity"),
        F.lit("pattern").alias("detector"))), lambda x: x["start"] < (k % 5) * 10)
    result = F.when(st == "finished", F.struct(found.alias("redactions")))
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("jobId"), st.alias("jobStatus"),
                              outputs.alias("outputFiles"), result.alias("result")))
    err = (F.when(st == "error",
                  F.when(k % 4 == 0, F.to_json(F.struct(F.lit("Detection failed").alias("title"),
                                                        F.concat(F.lit("code "), k.cast("string")).alias("detail"),
                                                        F.concat(F.lit("t"), eid).alias("traceId"))))
                  .when(k % 4 == 1, F.lit("{}"))
                  .when(k % 4 == 2, F.to_json(F.struct(k.alias("code"))))
                  .otherwise(F.to_json(F.struct(F.concat(F.lit("code "), k.cast("string")).alias("detail")))))
           .when((st == "finished") & (k % 9 == 0), F.to_json(F.struct(F.lit("Partial result").alias("title")))))
    body = F.when(err.isNull(), body).otherwise(
        F.concat(body.substr(F.lit(1), F.length(body) - 1),
                 F.lit(',"error":'), err, F.lit("}")))
    http = F.when(st == "inProgress", F.when(k % 10 == 0, F.lit(204)).otherwise(F.lit(202))).otherwise(F.lit(200))
    return e.select("event_id", F.col("user_id").alias("job_id"), "ts", http.alias("http"), body.alias("json"),
                    "k")


def saved_redactions(responses: DataFrame) -> DataFrame:
    """M9: what a user saved for the redaction step, in the shapes the redaction
    step accepts (and some it refuses): full response, ``{redactions}``, bare array,
    ``result: null``, a wrongly typed ``result.redactions``, broken JSON."""
    k = F.col("k")
    arr = F.coalesce(F.get_json_object(F.col("json"), "$.result.redactions"), F.lit("[]"))
    doc = (F.when(k % 6 == 0, F.col("json"))
           .when(k % 6 == 1, F.concat(F.lit('{"redactions":'), arr, F.lit("}")))
           .when(k % 6 == 2, arr)
           .when(k % 6 == 3, F.concat(F.lit('{"result":null,"redactions":'), arr, F.lit("}")))
           .when(k % 6 == 4, F.concat(F.lit('{"result":{"redactions":"s"},"redactions":'), arr, F.lit("}")))
           .otherwise(F.concat(F.lit('{"redactions":'), arr)))
    return responses.select(F.col("event_id").alias("case_id"), doc.alias("json"))

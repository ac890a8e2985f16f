"""Protection of stored text: P1 protect, P2 unprotect, P3 token expiry.

AES-256-GCM through Spark's ``aes_encrypt``/``try_aes_decrypt``.  Keys are
columns joined from a key table (never literals, which would be printed in
plans); the file id is the AAD, so ciphertext moved to another id does not
open.  Wrong keys give null (``try_``), never an exception.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shroud.session import exists, scratch_path
from shroud.sources.files import derive_dek, unwrap_token

MAX_KEYS = 1024  # key versions; the key table is broadcast only below this
N_DEMO_KEYS = 4
KEYS_SCHEMA = "key_id string, slot int, master binary"


def checked_keys(keys: DataFrame) -> DataFrame:
    """The key table with its size bound proven before it is broadcast."""
    key_count(keys)
    return keys.select("key_id", "slot", "master")


def key_count(keys: DataFrame) -> int:
    n = getattr(keys, "_shroud_key_count", None)
    if n is None:
        n = keys.limit(MAX_KEYS + 1).count()
        try:
            keys._shroud_key_count = n  # the key table is read once per load; count it once
        except AttributeError:
            pass
    if n > MAX_KEYS:
        raise ValueError(f"key table has more than {MAX_KEYS} rows; refusing to broadcast it")
    if n == 0:
        raise ValueError("key table is empty")
    return n


def load_or_create_keys(spark: SparkSession, path: str | None = None, n: int = N_DEMO_KEYS) -> DataFrame:
    """Master keys are inputs: one row per key version, ``slot`` 0..n-1.  For
    tests and demos random 32-byte keys are written once (so every later read,
    and every recomputed task, sees the same keys) below the shared
    checkpoint folder."""
    path = path or scratch_path(spark, "shroud-master-keys")
    if not exists(spark, path):
        rows = [(f"k{i + 1}", i, bytearray(os.urandom(32))) for i in range(n)]
        try:
            spark.createDataFrame(rows, KEYS_SCHEMA).write.mode("errorifexists").parquet(path)
        except Exception:
            # another job created the table first: use that one (keys are written once)
            if not exists(spark, path):
                raise
    return spark.read.parquet(path)


def protect(files: DataFrame, keys: DataFrame) -> DataFrame:
    """``content`` -> ``content_enc`` with the file's data key (random IV).

    Every file keeps its row: without its key version ``content_enc`` is null and ``reason`` says so."""
    cols = [c for c in files.columns if c not in ("content", "reason")]
    j = files.join(F.broadcast(checked_keys(keys).drop("slot")), "key_id", "left")
    dek = derive_dek(F.col("master"), F.col("file_id"))
    enc = F.aes_encrypt(F.col("content"), dek, F.lit("GCM"), F.lit("DEFAULT"), F.lit(""),
                        F.col("file_id").cast("binary"))
    reason = F.when(F.col("master").isNull(), F.lit("unknown key")).when(F.col("content").isNull(), F.lit("no content"))
    return j.select(*cols, enc.alias("content_enc"), reason.alias("reason"))


def unprotect(protected: DataFrame, requests: DataFrame, keys: DataFrame) -> DataFrame:
    """Open ``content_enc`` with the presented token, else a refusal reason.

    ``requests``: file_id, dek_token (the presented one).  Output: file_id,
    content (null when refused), reason (null when opened).
    """
    p = protected.select("file_id", "key_id", "content_enc", F.lit(True).alias("_found"))
    r = requests.select("file_id", F.col("dek_token").alias("req_token"))
    j = r.join(p, "file_id", "left").join(F.broadcast(checked_keys(keys).drop("slot")), "key_id", "left")
    dek = unwrap_token(F.col("master"), F.col("file_id"), F.col("req_token"))
    text = F.try_aes_decrypt(F.col("content_enc"), dek, F.lit("GCM"), F.lit("DEFAULT"),
                             F.col("file_id").cast("binary")).cast("string")
    reason = (F.when(F.col("_found").isNull(), F.lit("unknown file"))
              .when(F.col("master").isNull(), F.lit("unknown key"))
              .when(dek.isNull(), F.lit("bad token"))
              .when(F.col("content_enc").isNull(), F.lit("no content"))
              .when(text.isNull(), F.lit("moved content")))
    return j.select("file_id", text.alias("content"), reason.alias("reason"))


def _buckets(ts: Column, ttl_minutes: int) -> Column:
    return (F.unix_micros(ts) / F.lit(ttl_minutes * 60 * 1_000_000)).cast("bigint")


def _minutes() -> Column:
    return F.floor((F.unix_micros("use_ts") - F.unix_micros("issue_ts")) / F.lit(60_000_000)).cast("bigint").alias("minutes")


def token_uses(issues: DataFrame, uses: DataFrame, ttl_minutes: int = 1440,
               key: str = "user_id") -> DataFrame:
    """One row per use that falls in ``[issue.ts, issue.ts + ttl]`` of an issue of the same
    key, with its latest such issue.

    No pairs: time is cut into buckets one TTL wide, an issue is sent to its own and
    the next bucket, and inside (key, bucket) a use takes the last issue before it.  A
    busy key is spread over its buckets, and the cost is linear in its events.
    """
    i = issues.select(F.col(key), F.col("ts"), F.lit(None).cast("bigint").alias("use_id"), F.col("event_id").alias("issue_id"),
                      F.explode(F.array(_buckets(F.col("ts"), ttl_minutes), _buckets(F.col("ts"), ttl_minutes) + 1)).alias("bucket"))
    u = uses.select(F.col(key), F.col("ts"), F.col("event_id").alias("use_id"), F.lit(None).cast("bigint").alias("issue_id"),
                    _buckets(F.col("ts"), ttl_minutes).alias("bucket"))
    # issues before uses of the same instant, larger ids later
    w = Window.partitionBy(key, "bucket").orderBy("ts", F.col("use_id").isNotNull(), "issue_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("issue_id").isNotNull(), F.struct("issue_id", "ts")), ignorenulls=True).over(w)
    found = i.unionByName(u).withColumn("_last", last).where(F.col("use_id").isNotNull() & F.col("_last").isNotNull())
    live = found.select(F.col("_last.issue_id").alias("issue_id"), "use_id", key, F.col("ts").alias("use_ts"), F.col("_last.ts").alias("issue_ts")) \
        .where(F.col("use_ts") <= F.col("issue_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(ttl_minutes)))
    return live.select("issue_id", "use_id", key, _minutes())


def token_use_pairs(issues: DataFrame, uses: DataFrame, ttl_minutes: int = 1440, key: str = "user_id") -> DataFrame:
    """Every live (issue, use) pair, as an interval join on (key, bucket): the form a
    stream-stream join can run (T3), reduced afterwards by :func:`latest_issue`."""
    i = issues.select(F.col("event_id").alias("issue_id"), F.col(key), F.col("ts").alias("issue_ts"),
                      F.explode(F.array(_buckets(F.col("ts"), ttl_minutes), _buckets(F.col("ts"), ttl_minutes) + 1)).alias("bucket"))
    u = uses.select(F.col("event_id").alias("use_id"), F.col(key).alias("_k"),
                    F.col("ts").alias("use_ts"), _buckets(F.col("ts"), ttl_minutes).alias("_b"))
    cond = ((i[key] == u["_k"]) & (i["bucket"] == u["_b"])
            & (u["use_ts"] >= i["issue_ts"])
            & (u["use_ts"] <= i["issue_ts"] + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(ttl_minutes))))
    return i.join(u, cond, "inner").select("issue_id", "use_id", F.col(key), "issue_ts", "use_ts")


def latest_issue(pairs: DataFrame, key: str = "user_id") -> DataFrame:
    """One row per use of a table of pairs: its latest issue (partial maxima per task)."""
    best = pairs.groupBy("use_id", key, "use_ts").agg(F.max(F.struct("issue_ts", "issue_id")).alias("b"))
    return best.select(F.col("b.issue_id").alias("issue_id"), "use_id", key, "use_ts", F.col("b.issue_ts").alias("issue_ts")) \
        .select("issue_id", "use_id", key, _minutes())

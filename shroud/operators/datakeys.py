"""Stored data keys: made once, wrapped under a master key, re-wrapped on rotation.

Every file has its own random 32-byte data key.  The key table holds it only wrapped
(AES-GCM under a master key version, bound to file id and version), so changing the master key
re-wraps some 100 bytes per file and leaves the content as it is.

The table is a sequence of versions below one folder, each written whole before it counts
(its ``_SUCCESS`` file); readers take the last complete one.  A random column must not be computed
twice, so keys are written before anything is encrypted with them.

A token, ``<key version>.<wrapped key>``, is the wrapped key as the file's owner holds it.  After a
rotation tokens of the former version are refused.  Master keys arrive as a joined
column of a small checked table, never as literals.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from shroud.operators.protect import checked_keys
from shroud.session import exists

KEY_BYTES = 32
TABLE = ("file_id", "key_id", "wrapped", "retired")


def _random_key(file_id: Column) -> Column:
    @F.pandas_udf(BinaryType())
    def random_key(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([os.urandom(KEY_BYTES) for _ in range(len(part))])

    return random_key.asNondeterministic()(file_id)


def _bound(file_id: Column, key_id: Column) -> Column:
    return F.concat(file_id, F.lit("\u0000"), key_id).cast("binary")


def _wrap(dek: Column, master: Column, file_id: Column, key_id: Column) -> Column:
    return F.aes_encrypt(dek, master, F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), _bound(file_id, key_id))


def _unwrap(wrapped: Column, master: Column, file_id: Column, key_id: Column) -> Column:
    return F.try_aes_decrypt(wrapped, master, F.lit("GCM"), F.lit("DEFAULT"), _bound(file_id, key_id))


def _with_master(df: DataFrame, masters: DataFrame) -> DataFrame:
    """``master`` by ``key_id`` (null for a version that is gone); the table's size is checked before it is broadcast."""
    return df.join(F.broadcast(checked_keys(masters).drop("slot")), "key_id", "left")


def _versions(spark: SparkSession, root: str) -> int:
    """The last complete version, 0 if there is none."""
    n = 0
    while exists(spark, f"{root}/data-keys/v{n + 1}/_SUCCESS"):
        n += 1
    return n


def data_keys(spark: SparkSession, root: str) -> DataFrame:
    n = _versions(spark, root)
    if not n:
        raise ValueError(f"no data keys below {root}")
    return spark.read.parquet(f"{root}/data-keys/v{n}")


def create(file_ids: DataFrame, masters: DataFrame, root: str) -> DataFrame:
    """Make the data keys of the files once.  Files are spread over the master key versions."""
    from shroud.sources.files import assign_keys
    spark = file_ids.sparkSession
    if _versions(spark, root):
        raise ValueError(f"data keys exist below {root}; add files with add()")
    _write(spark, root, 1, _new_keys(file_ids, masters, assign_keys))
    return data_keys(spark, root)


def _new_keys(file_ids: DataFrame, masters: DataFrame, assign) -> DataFrame:
    ids = file_ids.select("file_id").where(F.col("file_id").isNotNull()).distinct()
    fresh = assign(ids, masters).withColumn("dek", _random_key(F.col("file_id")))
    return fresh.select("file_id", "key_id", _wrap(F.col("dek"), F.col("master"), F.col("file_id"), F.col("key_id")).alias("wrapped"),
                        F.array().cast("array<string>").alias("retired"))


def add(file_ids: DataFrame, masters: DataFrame, root: str) -> DataFrame:
    """Keys for the ids that have none; the others keep theirs."""
    from shroud.sources.files import assign_keys
    spark = file_ids.sparkSession
    have = data_keys(spark, root)
    new = file_ids.select("file_id").distinct().join(have.select("file_id"), "file_id", "left_anti")
    _write(spark, root, _versions(spark, root) + 1, have.unionByName(_new_keys(new, masters, assign_keys)))
    return data_keys(spark, root)


def _write(spark: SparkSession, root: str, version: int, rows: DataFrame) -> None:
    # an attempt that was killed has no _SUCCESS and is overwritten
    rows.select(*TABLE).sort("file_id").write.mode("overwrite").parquet(f"{root}/data-keys/v{version}")


def rotate(spark: SparkSession, root: str, masters: DataFrame, retire: str, to: str) -> DataFrame:
    """Re-wrap all keys of version ``retire`` under version ``to``.  Both masters must be in ``masters``; after it ``retire`` may go.

    Fails before anything is written if a key does not open: a lost key is lost content."""
    if retire == to:
        raise ValueError("rotation needs another key version")
    known = {r["key_id"] for r in checked_keys(masters).select("key_id").collect()}
    if missing := {retire, to} - known:
        raise ValueError(f"no master key for {sorted(missing)}")
    have = data_keys(spark, root)
    new_master = checked_keys(masters).where(F.col("key_id") == to).select(F.col("master").alias("new_master"), F.lit(retire).alias("key_id"))
    old = _with_master(have.where(F.col("key_id") == retire), masters).join(F.broadcast(new_master), "key_id")
    dek = _unwrap(F.col("wrapped"), F.col("master"), F.col("file_id"), F.col("key_id"))
    opened = F.when(dek.isNotNull(), dek).otherwise(F.raise_error(F.concat(F.lit("data key does not open: "), F.col("file_id"))).cast("binary"))
    moved = old.select("file_id", F.lit(to).alias("key_id"), _wrap(opened, F.col("new_master"), F.col("file_id"), F.lit(to)).alias("wrapped"),
                       F.array_append("retired", F.lit(retire)).alias("retired"))
    _write(spark, root, _versions(spark, root) + 1, have.where(F.col("key_id") != retire).unionByName(moved))
    return data_keys(spark, root)


def issue_tokens(keys: DataFrame) -> DataFrame:
    """``(file_id, dek_token)`` as handed out to the files' owners."""
    return keys.select("file_id", F.concat("key_id", F.lit("."), F.base64("wrapped")).alias("dek_token"))


def opened_keys(keys: DataFrame, masters: DataFrame) -> DataFrame:
    """``(file_id, key_id, dek)`` for the service itself; ``dek`` is null where the master key is gone."""
    return _with_master(keys, masters).select("file_id", "key_id", _unwrap(F.col("wrapped"), F.col("master"), F.col("file_id"), F.col("key_id")).alias("dek"))


def check_requests(meta: DataFrame, requests: DataFrame, keys: DataFrame, masters: DataFrame, ttl_minutes: int = 1440) -> DataFrame:
    """``(file_id, dek, reason)`` per request, from narrow rows only: ``meta`` (file_id, created_at), ``requests`` (file_id,
    dek_token, requested_at).  Granted (``reason`` is null) only when every test is true; refused rows carry no key."""
    m = meta.select(F.col("file_id").alias("__mid"), "created_at", F.lit(True).alias("_found"))
    k = keys.select(F.col("file_id").alias("__kid"), "key_id", "retired")
    r = requests.select("file_id", F.col("dek_token").alias("token"), "requested_at")
    j = r.join(m, F.col("file_id") == F.col("__mid"), "left").join(k, F.col("file_id") == F.col("__kid"), "left")
    j = _with_master(j, masters)
    version, body = F.substring_index("token", ".", 1), F.try_to_binary(F.substring_index("token", ".", -1), F.lit("base64"))
    dek = F.when(version == F.col("key_id"), _unwrap(body, F.col("master"), F.col("file_id"), F.col("key_id")))
    ends = F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(ttl_minutes))
    j = j.withColumn("dek", dek)
    reason = (F.when(F.col("_found").isNull(), F.lit("unknown file"))
              .when(F.coalesce(F.array_contains("retired", version), F.lit(False)), F.lit("old key version"))
              .when(F.col("master").isNull(), F.lit("unknown key"))
              .when(F.col("dek").isNull(), F.lit("bad token"))
              .when(F.col("requested_at").isNull(), F.lit("no request time"))
              .when(~F.coalesce(F.col("requested_at") >= F.col("created_at"), F.lit(False)), F.lit("not yet valid"))
              .when(~F.coalesce(F.col("requested_at") <= ends, F.lit(False)), F.lit("expired")))
    j = j.withColumn("reason", reason)
    return j.select("file_id", F.when(F.col("reason").isNull(), F.col("dek")).alias("dek"), "reason")


def decrypt(content_enc: Column, dek: Column, file_id: Column) -> Column:
    return F.try_aes_decrypt(content_enc, dek, F.lit("GCM"), F.lit("DEFAULT"), file_id.cast("binary")).cast("string")


def download(table: DataFrame, checked: DataFrame) -> DataFrame:
    """``(file_id, content, reason)``; ciphertext is read and opened for granted requests only."""
    granted = checked.where(F.col("reason").isNull()).select(F.col("file_id").alias("__gid"), "dek")
    met = table.select("file_id", "content_enc").join(granted, F.col("file_id") == F.col("__gid"))
    text = decrypt(F.col("content_enc"), F.col("dek"), F.col("file_id"))
    opened = met.select("file_id", text.alias("content")).withColumn("reason", F.when(F.col("content").isNull(), F.lit("no content")))
    refused = checked.where(F.col("reason").isNotNull()).select("file_id", F.lit(None).cast("string").alias("content"), "reason")
    return opened.unionByName(refused)

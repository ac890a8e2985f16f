"""Quality selection by importance resampling of hashed n-grams.

Two generative models over ``BUCKETS`` hashed word n-grams (bags, with
additive smoothing): one of target text (documents labelled good) and one of all raw
text.  A document's log importance weight is the sum over its n-grams of
log p_target - log p_raw; adding Gumbel noise from a hash of its id and taking the
top k is sampling k documents without replacement in proportion to the weights.

Counts cover every word of every document (two passes over the text: counting,
scoring).  Each task adds up its own buckets, so the shuffle has at most ``BUCKETS``
rows per task; the models that go to the tasks are 2 x ``BUCKETS`` numbers.

The top k is exact without sorting everything: keys are cut into slices by their
order-preserving bits, slices are counted, and only the slice that holds the k-th key is refined again.

Defined results: null and empty texts have weight 0 (no evidence); null ids share a hash
with their text's; rows equal in key are taken in order of text hash, and fully
repeated rows together, so ties can exceed k by their number; without target rows every weight is 0; an empty table gives no
rows; extra columns are kept, clashing ones replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .bytewords import NONSPACE, mix, words_of

BUCKETS = 16_384
SMOOTHING = 1.0
#: Slices per refinement of the k-th key.
SLICES = 4096


def buckets_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word and every pair of neighbouring words of a text."""
    words, n = words_of(texts, NONSPACE)
    text = np.repeat(np.arange(len(n)), n)
    pair = np.flatnonzero(text[1:] == text[:-1])
    two = mix(words[:-1][pair] * np.uint64(3) + words[1:][pair])
    ids = np.concatenate([mix(words), two]) % np.uint64(BUCKETS)
    return np.concatenate([text, text[pair]]), ids.astype(np.int64)


def counts(df: DataFrame, is_target: Column, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Raw and target counts of every bucket, over all rows."""
    rows = df.select(F.col(text_col).alias("__text"), F.coalesce(is_target, F.lit(False)).alias("__target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            good = batch.column("__target").to_numpy(zero_copy_only=False)
            at = 0
            for part in common.blocks(texts, lambda t: len(t or "")):
                row, ids = buckets_of(part)
                total[0] += np.bincount(ids, minlength=BUCKETS)
                total[1] += np.bincount(ids[good[at:at + len(part)][row].astype(bool)], minlength=BUCKETS)
                at += len(part)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])],
                                         names=["bucket", "raw", "target"])

    found = rows.mapInArrow(run, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # at most BUCKETS rows
    out = np.zeros((2, BUCKETS), np.int64)
    for r in found:
        out[:, r["bucket"]] = r["raw"], r["target"]
    return out[0], out[1]


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    p = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return p(target) - p(raw)


def gumbel(key: Column, seed: str = "resample") -> Column:
    """Standard Gumbel noise from 52 bits of an MD5 of the key."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, value: str, k: int) -> float | None:
    """The k-th largest of a double column (None: fewer rows), by refining slices of its range."""
    r = df.agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if k < 1 or r["n"] < k:
        return None
    low, high = r["lo"], r["hi"]
    while low < high:
        step = (high - low) / SLICES
        if not np.isfinite(step) or low + step <= low:
            break
        inside = df.filter((F.col(value) >= low) & (F.col(value) <= high))
        slices = inside.groupBy(F.least(F.floor((F.col(value) - low) / step), F.lit(SLICES - 1)).alias("s")).agg(
            F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()  # at most SLICES rows
        for s in sorted(slices, key=lambda x: -x["s"]):
            if k <= s["n"]:
                low, high = s["lo"], s["hi"]
                break
            k -= s["n"]
    if low == high:
        return low
    # a slice too narrow to cut again
    return df.filter((F.col(value) >= low) & (F.col(value) <= high)).orderBy(F.col(value).desc()).limit(k).agg(F.min(value)).first()[0]


def resample(df: DataFrame, is_target: Column, *, share: float | None = None, k: int | None = None,
             id_col: str = "doc_id", text_col: str = "text", seed: str = "resample") -> DataFrame:
    """All rows of ``df`` plus ``log_weight``, ``gumbel_key`` and ``selected`` (the top ``k``, or ``share`` of all rows)."""
    raw, target = counts(df, is_target, text_col)
    shared = df.sparkSession.sparkContext.broadcast(log_ratio(raw, target))

    @F.pandas_udf("double")
    def weigh(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        for part in parts:
            out = []
            for texts in common.blocks(part.tolist(), lambda t: len(t or "")):
                row, ids = buckets_of(texts)
                out.append(np.bincount(row, weights=table[ids], minlength=len(texts)))
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    noise = gumbel(F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col))), seed)
    scored = (df.drop("log_weight", "gumbel_key", "selected").withColumn("log_weight", weigh(F.col(text_col)))
              .withColumn("gumbel_key", F.col("log_weight") + noise))
    keys = common.materialize(scored.select(F.col(id_col).alias("__id"), common.text_hash(F.col(text_col)).alias("__th"), "gumbel_key"), "resample-keys")
    if k is None:
        k = int(np.ceil((1.0 if share is None else share) * keys.count()))
    edge = kth_largest(keys, "gumbel_key", k)
    chosen = F.lit(k > 0) if edge is None else F.col("gumbel_key") >= F.lit(edge)
    return scored.withColumn("selected", chosen)

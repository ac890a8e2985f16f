"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits: bit i is set when it is set in over half the XXH64
values of a text's shingles.  Fingerprints link at ``K`` = 3 or fewer differing
bits; the result is the connected component of every document.

Candidates come from distinct fingerprints only (copies collapse first).  The 64
bits form a ring of four 16-bit segments.  If two fingerprints differ in at most 3
bits, some start on the ring keeps every chain of l segments within l * 3/4
differences: 0 in the first, at most 1 in two, 2 in three, 3 in all.  So the first
segment is equal and the second has at most one difference, which leaves one of
its halves equal: the join key is (start, first segment, half of the second), 24
bits, 8 keys per fingerprint.  The chain budgets are tested before the full check.

A key shared by more than ``HOT_KEY`` fingerprints is not joined with itself.
There two linked fingerprints meet at a midpoint, one bit from the one and at most
two from the other, among the 40 bits outside the key.  All fingerprints within two
bits of a midpoint link to any one within one bit, so one star per midpoint
replaces the pairs: rows grow in proportion to the group.

Defined results: null and empty texts have fingerprint zero, linked like any other;
the component id is the smallest non-null id (null if a component has none);
repeated rows each get their row; extra columns are ignored; an empty table is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE_WORDS = 3
K = 3
SEED = 42
#: Shingles counted at once (64 bytes of work each).
SHINGLE_BLOCK = 1 << 17
#: Fingerprints of one join key that are compared pair by pair.
HOT_KEY = 512


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    import xxhash
    h64 = xxhash.xxh64_intdigest
    # bytes: lower() changes A-Z only and split() cuts at \x20 \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle_words:
        return h64(joined, SEED)  # one shingle: each bit is over half or not at all
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - shingle_words + 1].tolist()
    stops = ends[shingle_words - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLE_BLOCK):
        hashes = np.array([h64(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + SHINGLE_BLOCK], stops[at:at + SHINGLE_BLOCK], strict=True)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(__id, __th, fp)``, one row per document; ``fp`` is the fingerprint as a signed long."""
    rows = common.keyed(df, id_col, text_col)
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__th"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=["__id", "__th", "fp"])

    return rows.mapInArrow(common.tidied(run), f"__id {id_type}, __th bigint, fp bigint")


def _segment(col, i: int):
    return F.shiftrightunsigned(col, 16 * (i % 4)).bitwiseAND(0xFFFF)


def _keys(fps: DataFrame) -> DataFrame:
    """``(key, fp)``: 8 keys per fingerprint."""
    fp = F.col("fp")
    keys = [F.lit((2 * i + h) << 24).cast("long").bitwiseOR(F.shiftleft(_segment(fp, i), 8))
            .bitwiseOR(F.shiftrightunsigned(_segment(fp, i + 1), 8 * h).bitwiseAND(0xFF))
            for i in range(4) for h in (0, 1)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _chain(x, start: int):
    """The pigeonring test of one start: chains of 1, 2, 3, 4 segments within 0, 1, 2, 3 differences."""
    counts = [F.bit_count(_segment(x, start + j)) for j in range(4)]
    sums = [counts[0]]
    for c in counts[1:]:
        sums.append(sums[-1] + c)
    return (sums[0] == 0) & (sums[1] <= 1) & (sums[2] <= 2) & (sums[3] <= K)


def _masks(bits: list[int], most: int) -> list[int]:
    """All words with at most ``most`` of these bits set, as signed longs."""
    words = [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(bits, n)]
    return [w - (1 << 64) if w >> 63 else w for w in words]


def _array(words: list[int]):
    """A constant array, as one expression text (one parse instead of a call per word)."""
    return F.expr(f"array({', '.join(f"cast('{w}' AS bigint)" for w in words)})")


def _hot_links(hot: DataFrame) -> DataFrame:
    """Stars through midpoints for the fingerprints of crowded keys."""
    parts = []
    for i in range(4):
        for h in (0, 1):
            fixed = {16 * i + b for b in range(16)} | {16 * ((i + 1) % 4) + 8 * h + b for b in range(8)}
            free = [b for b in range(64) if b not in fixed]
            own = hot.filter(F.shiftrightunsigned("key", 24) == 2 * i + h)
            mid = lambda most, own=own, free=free: own.withColumn(
                "mask", F.explode(_array(_masks(free, most)))) \
                .select("key", "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("mid"))
            centre = mid(1).groupBy("key", "mid").agg(F.min("fp").alias("a"))
            parts.append(mid(2).join(centre, ["key", "mid"]).filter("a <> fp").select("a", F.col("fp").alias("b")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.distinct()


def links(fps: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """``(a, b)`` links among distinct fingerprints ``fps(fp)`` whose components are
    those of all pairs within ``K`` bits (every pair itself, except in crowded keys)."""
    keys = _keys(fps)
    crowd = common.materialize(keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1), "simhash-keys")
    keys = keys.join(crowd, "key")
    usual = keys.filter(F.col("n") <= hot_key)
    left, right = usual.select("key", F.col("fp").alias("a")), usual.select(F.col("key").alias("key2"), F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    start = F.shiftrightunsigned("key", 25)
    test = F.lit(False)
    for i in range(4):
        test = test | ((start == i) & _chain(x, i))
    pairs = left.join(right, (F.col("key") == F.col("key2")) & (F.col("a") < F.col("b")) & test).select("a", "b").distinct()
    if crowd.filter(F.col("n") > hot_key).isEmpty():
        return pairs
    return pairs.unionAll(_hot_links(keys.filter(F.col("n") > hot_key).select("key", "fp")))


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, hot_key: int = HOT_KEY) -> DataFrame:
    """``(__id, __th, fp, root, component_id)`` for every row; ``root`` names the component."""
    rows = common.materialize(fingerprints(df, id_col, text_col, shingle_words), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("__id").alias("_first"))
    roots = components(links(distinct.select("fp"), hot_key))
    named = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "fp")).select("fp", "_first", "root"))
    named = common.materialize(named, "simhash-roots")
    least = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    groups = named.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return rows.join(groups, F.col("fp") == F.col("_fp")).drop("_fp")


def deduplicate(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Keep one row of each component: the one with the smallest (id, text hash), null ids last."""
    found = near_duplicates(df, id_col=id_col, text_col=text_col, **options)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull(), "__id", "__th")).alias("_k"))
    kept = found.join(first.select(F.col("root").alias("_root"), "_k"), F.col("root") == F.col("_root"))
    same = F.col("__id").eqNullSafe(F.col("_k.__id")) & (F.col("__th") == F.col("_k.__th"))
    keys = kept.filter(same).groupBy("__id", "__th").agg(F.count("*").alias("__n"))
    rows = common.join_flags(df, keys, id_col, text_col, "inner")
    # a repeated row (same id and text) stays once
    once = rows.filter(F.col("__n") == 1).drop("__n")
    repeated = rows.filter(F.col("__n") > 1).drop("__n").withColumn("__th", common.text_hash(F.col(text_col)))
    return once.unionByName(repeated.dropDuplicates([id_col, "__th"]).drop("__th"))

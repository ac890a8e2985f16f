"""Removal of long repeated byte strings by column-wise multi-document construction.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else in the
collection (same document included) is removed; strings are judged on the input.

1. *Candidates.*  Each string of ``LENGTH`` bytes picks the ``GRAM``-byte gram inside it
   with the smallest hash (the last one on ties) as its anchor, so equal strings pick
   equal grams at the same offset.  The strings of one anchor start in a run
   ``lo..hi`` and cover a region of under 2 x ``LENGTH`` bytes.  One row per anchor
   (about 1 per 170 bytes) goes through the shuffle: hash of the gram, hash of the region.
2. *Counting.*  A region that occurs twice is a repeat as a whole.  A region whose
   anchor occurs once has none.  Only the others, at the edges of repeats, are left.
3. *Construction.*  The distinct regions of an anchor, lined up at the anchor, are
   documents of a small collection.  From the last column to the first, one symbol per
   document is put before its suffix; the suffixes' order and common prefixes follow
   from those of the round before (a stable sort by the new symbol; 1 + the least
   common prefix between two suffixes that get the same symbol).  A string repeats
   when a neighbour in that order shares ``LENGTH`` symbols.  Equal strings sit in the
   same column, so the rounds need not be merged into one transform.  Collections
   are read in anchor order from a table in the shared folder, many anchors at a time.
4. An anchor with more than ``MAX_REGIONS`` distinct regions isn't held in one task:
   its strings are counted one by one by their hash, with map-side combine.

Equality of grams, regions and (case 4) strings is equality of a gram's 64-bit
hash and a second 64-bit hash together.

Defined results: null texts are empty; texts under ``LENGTH`` bytes keep all; repeated
rows are repeats of each other; null ids keep their rows; an empty table is empty;
extra columns are ignored by the digest and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords, common

LENGTH = 400
GRAM = 64
#: Bytes worked on at once; position in a block must fit in _POS bits.
BLOCK = 1 << 20
_POS = 24
#: Regions of one anchor that one task may hold (under 150 MB of columns).
MAX_REGIONS = 50_000
#: Regions per collection; an anchor is never divided.
COLLECTION = 16_384


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, from block-wise running minima."""
    n = len(key) - width + 1
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(key)] = key
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of string starts with the same anchor: (lo, hi, anchor, anchor hash).
    ``data`` is one or more texts laid end to end, ``ends`` their ends; no string crosses one."""
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    if len(data) < length:
        return none
    at = np.arange(len(data) - gram + 1)
    hashes = bytewords.span_ids(bytewords.prefix(data), at, at + gram)
    low = np.uint64((1 << _POS) - 1)
    key = (hashes & ~low) | (low - at.astype(np.uint64))
    anchor = (low - (_sliding_min(key, length - gram + 1) & low)).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(ends, starts, side="right")
    starts = starts[starts + length <= ends[np.minimum(text, len(ends) - 1)]]
    if not len(starts):
        return none
    anchor = anchor[starts]
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new - 1, [len(starts) - 1]])
    return starts[first], starts[last], anchor[first], hashes[anchor[first]]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchors(df: DataFrame, *, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    """``(__id, __th, lo, hi, p, a, r)``: starts, anchor position, anchor hash, region hash."""
    rows = common.keyed(df, id_col, text_col)
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        h64 = xxhash.xxh3_64_intdigest

        def out(batch, raw, ends, base, row_of):
            lo, hi, p, a = anchor_runs(np.frombuffer(raw, np.uint8), ends, length, gram)
            row = row_of(np.searchsorted(ends, lo, side="right"))
            r = np.array([h64(raw[x:y]) for x, y in zip(lo.tolist(), (hi + length).tolist(), strict=True)], np.uint64)
            off = base(row)
            return pa.RecordBatch.from_arrays(
                [batch.column("__id").take(pa.array(row)), batch.column("__th").take(pa.array(row)),
                 pa.array(lo - off, pa.int64()), pa.array(hi - off, pa.int64()), pa.array(p - off, pa.int64()),
                 pa.array(a.view(np.int64)), pa.array(r.view(np.int64))],
                names=["__id", "__th", "lo", "hi", "p", "a", "r"])

        for batch in batches:
            texts = [_bytes(t.as_py()) for t in batch.column("__text")]
            at = 0
            for part in common.blocks(texts, len, BLOCK):
                if len(part) == 1 and len(part[0]) > BLOCK:  # one long text, in overlapping pieces
                    for cut in range(0, len(part[0]) - length + 1, BLOCK):
                        raw = part[0][cut:cut + BLOCK + length - 1]
                        yield out(batch, raw, np.array([len(raw)]), lambda row, cut=cut: np.full(len(row), -cut),
                                  lambda t, at=at: np.full(len(t), at))
                else:
                    ends = np.cumsum([len(d) for d in part])
                    begin = np.concatenate([[0], ends[:-1]])
                    yield out(batch, b"".join(part), ends, lambda row, begin=begin, at=at: begin[row - at], lambda t, at=at: t + at)
                at += len(part)

    return rows.mapInArrow(common.tidied(run), f"__id {id_type}, __th bigint, lo bigint, hi bigint, p bigint, a bigint, r bigint")


def repeats_in_collection(regions: list[bytes], anchor: np.ndarray, length: int):
    """Column-wise construction over regions lined up at ``anchor`` (its offset in each).
    Returns (region, first start, last start) of every run of repeated strings."""
    n = len(regions)
    sizes = np.array([len(r) for r in regions])
    origin = int(anchor.max())
    width = int((sizes - anchor).max()) + origin
    columns = np.full((width, n), -1, np.int16)  # -1: no symbol; such suffixes share nothing
    where = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(origin - anchor, sizes)
    columns[where, np.repeat(np.arange(n), sizes)] = np.frombuffer(b"".join(regions), np.uint8)
    order = np.arange(n)
    common_prefix = np.zeros(n + 1, np.int16)  # with the suffix before; one spare
    marks = np.zeros((width + 2, n), np.int8)
    for t in range(width - 1, -1, -1):
        symbol = columns[t][order]
        move = np.argsort(symbol, kind="stable")
        symbol = symbol[move]
        least = np.minimum.reduceat(common_prefix, move + 1)[:-1] if n > 1 else np.empty(0, np.int16)
        same = (symbol[1:] == symbol[:-1]) & (symbol[1:] >= 0)
        common_prefix = np.zeros(n + 1, np.int16)
        common_prefix[1:n] = np.where(same, np.minimum(least + 1, length), 0)
        order = order[move]
        long = np.flatnonzero(common_prefix[:n] >= length)
        marks[t + 1, order[long]] = 1
        marks[t + 1, order[long - 1]] = 1
    step = np.diff(marks.T, axis=1)
    region, first = np.nonzero(step == 1)
    last = np.nonzero(step == -1)[1] - 1
    shift = anchor[region] - origin
    return region, first + shift, last + shift


def _construct(length: int, schema_names: list[str]):
    """Tasks over regions sorted by anchor hash."""
    def solve(rows: list[dict]) -> pa.RecordBatch:
        lo = np.array([r["lo"] for r in rows])
        region, first, last = repeats_in_collection([r["data"] for r in rows], np.array([r["p"] for r in rows]) - lo, length)
        pick = region.tolist()
        return [rows[i]["__id"] for i in pick], [rows[i]["__th"] for i in pick], lo[region] + first, lo[region] + last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        held: list[dict] = []

        def emit():
            ids, ths, first, last = solve(held)
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(ths, pa.int64()), pa.array(first, pa.int64()),
                                               pa.array(last, pa.int64())], names=schema_names)

        for batch in batches:
            id_type = batch.schema.field("__id").type
            for row in batch.to_pylist():
                if len(held) >= COLLECTION and row["a"] != held[-1]["a"]:
                    yield emit()
                    held.clear()
                held.append(row)
        if held:
            yield emit()
    return run


def repeated_starts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    gram: int = GRAM, max_regions: int = MAX_REGIONS) -> DataFrame:
    """``(__id, __th, lo, hi)``: runs of starts of strings that also start elsewhere."""
    found = common.materialize(anchors(df, id_col=id_col, text_col=text_col, length=length, gram=gram), "anchors")
    id_type = found.schema["__id"].dataType.simpleString()
    each = Window.partitionBy("a")
    kinds = (found.groupBy("a", "r").agg(F.count("*").alias("n"))
             .withColumn("d", F.count("*").over(each)).withColumn("total", F.sum("n").over(each))
             .filter("total > 1").select("a", "r", "n", "d"))
    left = common.materialize(found.join(kinds, ["a", "r"]), "repeated-anchors")
    whole = left.filter("n > 1").select("__id", "__th", "lo", "hi")
    # edges: regions that occur once, and one of each other region of their anchors
    once = left.filter("n = 1").select("__id", "__th", "lo", "hi", "p", "a", "d")
    one = (left.filter("n > 1 and d > 1").groupBy("a", "r", "d")
           .agg(F.min(F.struct("__id", "__th", "lo", "hi", "p")).alias("k")).select("k.*", "a", "d"))
    wanted = once.unionByName(one).groupBy("__id", "__th").agg(F.collect_list(F.struct("lo", "hi", "p", "a", "d")).alias("want"))
    texts = common.keyed(df, id_col, text_col).withColumnsRenamed({"__id": "__jid", "__th": "__jth"})
    joined = wanted.join(texts, F.col("__jid").eqNullSafe(F.col("__id")) & (F.col("__jth") == F.col("__th"))) \
        .select("__id", "__th", "want", "__text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = _bytes(batch.column("__text")[i].as_py())
                want = batch.column("want")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("__id")[i].as_py()] * len(want), batch.schema.field("__id").type),
                     pa.array([batch.column("__th")[i].as_py()] * len(want), pa.int64()),
                     *(pa.array([w[k] for w in want], pa.int64()) for k in ("lo", "hi", "p", "a", "d")),
                     pa.array([data[w["lo"]:w["hi"] + length] for w in want], pa.binary())],
                    names=["__id", "__th", "lo", "hi", "p", "a", "d", "data"])

    regions = common.materialize(joined.mapInArrow(
        cut, f"__id {id_type}, __th bigint, lo bigint, hi bigint, p bigint, a bigint, d bigint, data binary"), "edge-regions")
    names = ["__id", "__th", "lo", "hi"]
    edges = (regions.filter(F.col("d") <= max_regions).drop("d", "hi").repartition("a").sortWithinPartitions("a")
             .mapInArrow(common.tidied(_construct(length, names)), f"__id {id_type}, __th bigint, lo bigint, hi bigint"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            lists = [[xxhash.xxh3_64_intdigest(d[s:s + length]) - (1 << 63) for s in range(len(d) - length + 1)]
                     for d in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("__id", "__th", "lo", "a")] + [pa.array(lists, pa.list_(pa.int64()))],
                                             names=["__id", "__th", "lo", "a", "h"])

    crowd = regions.filter(F.col("d") > max_regions)
    single = (crowd.mapInArrow(common.tidied(strings), f"__id {id_type}, __th bigint, lo bigint, a bigint, h array<bigint>")
              .select("__id", "__th", "lo", "a", F.posexplode("h").alias("i", "h")))
    twice = single.groupBy("a", "h").agg(F.count("*").alias("n")).filter("n > 1").select("a", "h")
    counted = single.join(twice, ["a", "h"]).select("__id", "__th", (F.col("lo") + F.col("i")).alias("lo"),
                                                    (F.col("lo") + F.col("i")).alias("hi"))
    return whole.unionByName(edges).unionByName(counted)


def _merged(runs: list[tuple[int, int]], length: int) -> list[list[int]]:
    """Removed byte spans [a, b) of one text, maximal and ascending."""
    out: list[list[int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length)
        else:
            out.append([lo, hi + length])
    return out


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """``df`` plus ``spans`` (flat list of removed byte spans), ``kept`` (remaining bytes) and
    ``n_bytes, n_removed, n_spans, kept_sha256``."""
    runs = repeated_starts(df, id_col=id_col, text_col=text_col, length=length, **options)
    per = runs.groupBy("__id", "__th").agg(F.collect_list(F.struct("lo", "hi")).alias("__runs"))
    added = "spans array<bigint>, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    keep = df.drop("spans", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    rows = common.join_flags(keep, per, id_col, text_col, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text, runs in zip(batch.column(text_col), batch.column("__runs"), strict=True):
                data = _bytes(text.as_py())
                spans = _merged([(r["lo"], r["hi"]) for r in runs.as_py() or ()], length)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                for c, v in zip(cols, ([x for s in spans for x in s], rest, len(data), len(data) - len(rest), len(spans),
                                       hashlib.sha256(rest).hexdigest()), strict=True):
                    c.append(v)
            types = [pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            old = [n for n in batch.schema.names if n != "__runs"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in old] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=[*old, "spans", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema.fields)
    return rows.mapInArrow(common.tidied(cut), f"{schema}, {added}")

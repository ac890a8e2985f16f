"""Benchmark decontamination over a distributed positional inverted index.

The index holds every token of the corpus.  It is partitioned by document: one
row per segment (a few MB of text) with the segment's documents, its terms in
ascending order, and the positions of each term as gaps.  It is written once
as Parquet in the shared folder; nothing is shuffled to build it.

A search broadcasts a block of the test set (bounded by ``QUERY_BYTES``; a larger
test set is searched in several blocks) and runs in every segment by itself.
For each phrase it takes the shortest posting list among its terms, subtracts the
term's offset, and keeps the starts whose other terms are in their lists at
their offsets, in order of list length.  Terms missing from a segment end its phrases at once.

* ``phrase_hits``: exact occurrences of word windows.
* ``proximity_hits``: documents in which all terms lie within ``slop`` words of an
  occurrence of the rarest.

Term ids are 64-bit hashes of the word's bytes; two different words would have to
collide in ten places in a row to give a false hit.

What a task holds is bounded: row groups of the index have ``common.GROUP_ROWS`` rows, test windows are
places in the block's words (some 40 bytes each) and are looked up ``PART_WINDOWS`` at a time.

Defined results: null texts have no words; an item without words has no window; an
item shorter than the window is one window; null item ids are named ``null``;
repeated item ids count once; repeated documents keep a row each; empty tables give
no rows, or no hits; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bytewords import ALNUM, mix, words_of

WINDOW = 10
#: Text of one segment.
SEGMENT_BYTES = 4 << 20
#: Text of the test set that is broadcast at once.
QUERY_BYTES = 8 << 20
#: Windows looked up at once, and positions of their shortest lists tried at once (one window's list may be longer).
PART_WINDOWS = 1 << 14
CANDIDATES = 1 << 19


def build_index(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index table: docs, ths, n_words | terms, n, gaps (positions of each term; first absolute, then gaps)."""
    rows = common.keyed(df, id_col, text_col)
    id_type = rows.schema["__id"].dataType.simpleString()

    def segment(ids, ths, texts) -> pa.RecordBatch:
        words, counts = words_of(texts, ALNUM)
        order = np.argsort(words, kind="stable")
        terms, first, n = np.unique(words[order], return_index=True, return_counts=True)
        gaps = np.diff(order, prepend=0)
        gaps[first] = order[first]
        one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             pa.ListArray.from_arrays(pa.array([0, len(ths)], pa.int32()), ths),
             one(counts, pa.int64()), one(terms.view(np.int64), pa.int64()), one(n, pa.int64()), one(gaps, pa.int32())],
            names=["docs", "ths", "n_words", "terms", "n", "gaps"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            at = 0
            for part in common.blocks(texts, lambda t: len(t or ""), SEGMENT_BYTES):
                stop = at + len(part)
                yield segment(batch.column("__id").slice(at, stop - at), batch.column("__th").slice(at, stop - at), part)
                at = stop

    index = rows.mapInArrow(common.tidied(run), f"docs array<{id_type}>, ths array<bigint>, n_words array<bigint>, "
                                 "terms array<bigint>, n array<bigint>, gaps array<int>")
    return common.materialize_wide(index, "postings", **{
        "compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"})


class Segment:
    """One row of the index, unpacked."""

    def __init__(self, row):
        col = lambda name: row.column(name).values.to_numpy(zero_copy_only=False)
        self.docs, self.ths, self.n_words = row.column("docs").values, row.column("ths").values, col("n_words")
        self.starts = np.concatenate([[0], np.cumsum(self.n_words)])
        self.terms, self.n = col("terms").view(np.uint64), col("n")
        self.offsets = np.concatenate([[0], np.cumsum(self.n)])
        gaps = col("gaps").astype(np.int64)
        run = np.cumsum(gaps)
        base = np.concatenate([[0], run])[self.offsets[:-1]]
        self.positions = run - np.repeat(base, self.n)
        #: (list, position) as one ascending number, for lookups in any list
        self.keys = np.repeat(np.arange(len(self.n), dtype=np.int64) << 32, self.n) + self.positions

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term's list, -1 if the segment lacks it."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1) if len(self.terms) else np.full(terms.shape, -1)

    def has(self, lists: np.ndarray, positions: np.ndarray) -> np.ndarray:
        key = (lists << 32) + positions
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return (self.keys[at] == key) & (positions >= 0)

    def expand(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query row, position) of the given lists."""
        n = self.n[lists]
        row = np.repeat(np.arange(len(lists)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return row, self.positions[self.offsets[lists][row] + inner]

    def phrases(self, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence inside one document; all windows have ``length`` words."""
        lists = self.lists(windows)
        alive = np.flatnonzero((lists >= 0).all(1))
        if not len(alive):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lists = lists[alive]
        rarest = np.argsort(self.n[lists], axis=1, kind="stable")
        # windows whose shortest lists have some CANDIDATES positions together are tried at once
        n = self.n[np.take_along_axis(lists, rarest[:, :1], 1)[:, 0]]
        run = (np.cumsum(n) - n) // CANDIDATES
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
        found = [(alive[a + row], start) for a, b in zip(cuts, cuts[1:], strict=False)
                 for row, start in [self._starts(lists[a:b], rarest[a:b], length)]]
        which, start = zip(*found, strict=True)
        return np.concatenate(which), np.concatenate(start)

    def _starts(self, lists: np.ndarray, rarest: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        pick = lambda k: (np.take_along_axis(lists, rarest[:, k:k + 1], 1)[:, 0], rarest[:, k])
        first, offset = pick(0)
        row, at = self.expand(first)
        start = at - offset[row]
        doc = np.searchsorted(self.starts, start, side="right") - 1
        keep = (start >= 0) & (start + length <= self.starts[np.minimum(doc + 1, len(self.starts) - 1)])
        row, start = row[keep], start[keep]
        for k in range(1, length):
            lst, off = pick(k)
            keep = self.has(lst[row], start + off[row])
            row, start = row[keep], start[keep]
        return row, start

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the rarest term with every other term within ``slop`` words in the same document."""
        lists = self.lists(terms)
        if (lists < 0).any():
            return np.empty(0, np.int64)
        order = np.argsort(self.n[lists], kind="stable")
        _, at = self.expand(lists[order[:1]])
        for k in order[1:]:
            doc = np.searchsorted(self.starts, at, side="right") - 1
            low = np.maximum(at - slop, self.starts[doc])
            high = np.minimum(at + slop, self.starts[doc + 1] - 1)
            shift = int(lists[k]) << 32
            at = at[np.searchsorted(self.keys, shift + low) < np.searchsorted(self.keys, shift + high, side="right")]
        return at


@dataclass
class Windows:
    """The distinct windows of a block of items: places in its words, and the items of each as numbers."""
    words: np.ndarray
    names: list
    #: length -> (starts in ``words``, ends of the windows' runs in the items, items)
    groups: dict

    def parts(self):
        """``(length, windows, first, ends, items)`` of at most ``PART_WINDOWS`` windows; ``first`` is the first one's number."""
        for length, (starts, ends, items) in self.groups.items():
            for a in range(0, len(starts), PART_WINDOWS):
                yield length, self.words[starts[a:a + PART_WINDOWS, None] + np.arange(length)], a, ends, items


def item_windows(ids: list, texts: list, window: int = WINDOW) -> Windows:
    words, counts = words_of(texts, ALNUM)
    names: dict[str, int] = {}
    owner = np.array([names.setdefault("null" if i is None else str(i), len(names)) for i in ids], np.int64)
    first, size = np.cumsum(counts) - counts, np.minimum(counts, window)
    groups = {}
    for length in np.unique(size[size > 0]).tolist():
        mine = size == length
        n = counts[mine] - length + 1
        starts = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        groups[length] = _distinct(words, starts, np.repeat(owner[mine], n), length)
    return Windows(words, list(names), groups)


def _distinct(words: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One start per distinct window, the ends of the windows' runs in the items, and the items."""
    code = np.zeros(len(starts), np.uint64)
    for k in range(length):
        code = mix(code) + words[starts + k]
    order = np.lexsort((owner, code))
    starts, owner, code = starts[order], owner[order], code[order]
    new = code[1:] != code[:-1]  # windows of one code are compared by their words
    for k in range(length):
        new |= words[starts[1:] + k] != words[starts[:-1] + k]
    fresh = np.concatenate([[True], new])
    keep = fresh | np.concatenate([[True], owner[1:] != owner[:-1]])
    owner, fresh_kept = owner[keep], np.flatnonzero(fresh[keep])
    return starts[fresh], np.append(fresh_kept[1:], len(owner)), owner


def _query_blocks(items: DataFrame, id_col: str, text_col: str):
    """The test set in blocks of about ``QUERY_BYTES``, each collected by itself."""
    rows = items.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter(F.col(text_col).isNotNull())
    size = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n = int(size // QUERY_BYTES) + 1
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("__id", "__text"), F.lit(n)) == i) if n > 1 else rows
        yield [(r["__id"], r["__text"]) for r in part.collect()]


def phrase_hits(index: DataFrame, items: DataFrame, *, item_id: str = "item_id", item_text: str = "text",
                window: int = WINDOW) -> DataFrame:
    """``(__id, __th, n_words, spans, items)`` for every document: merged word spans
    [start, end) covered by windows (flat list) and the names of the items found."""
    spark = index.sparkSession
    schema = index.schema
    id_type = schema["docs"].dataType.elementType.simpleString()
    parts = []
    for block in _query_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(item_windows([b[0] for b in block], [b[1] for b in block], window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _search(Segment(_row(batch, i)), shared.value)

        parts.append(index.mapInArrow(common.tidied(run), f"__id {id_type}, __th bigint, n_words bigint, spans array<bigint>, items array<string>"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    if len(parts) > 1:
        out = out.groupBy("__id", "__th", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
            F.count("*").alias("__rows"))
        # repeated documents keep a row each
        out = out.withColumn("__rows", F.explode(F.sequence(F.lit(1), F.expr(f"cast(__rows div {len(parts)} as int)")))).drop("__rows")
    return out


def _row(batch: pa.RecordBatch, i: int):
    """Row i with its lists cut out (``values`` of a slice are not cut by themselves)."""
    cut = [pa.ListArray.from_arrays(pa.array([0, len(c[i].values)], pa.int32()), c[i].values) for c in batch.columns]
    return pa.RecordBatch.from_arrays(cut, names=batch.schema.names)


def _search(seg: Segment, windows: Windows) -> pa.RecordBatch:
    total = int(seg.starts[-1])
    cover = np.zeros(total + 1, np.int64)
    found: dict[int, set] = {}
    for length, rows, first, ends, items in windows.parts():
        which, start = seg.phrases(rows, length)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + length, -1)
        docs = np.searchsorted(seg.starts, start, side="right") - 1
        pairs = np.unique(np.stack([docs, which + first]), axis=1)
        for d, w in pairs.T.tolist():
            found.setdefault(d, set()).update(items[ends[w - 1] if w else 0:ends[w]].tolist())
    covered = np.cumsum(cover[:-1]) > 0
    spans = []
    for d in range(len(seg.n_words)):
        if d not in found:
            spans.append([])
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered[seg.starts[d]:seg.starts[d + 1]], [0]])))
        spans.append(edge.tolist())
    return pa.RecordBatch.from_arrays(
        [seg.docs, seg.ths, pa.array(seg.n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
         pa.array([sorted(windows.names[i] for i in found.get(d, ())) for d in range(len(seg.n_words))], pa.list_(pa.string()))],
        names=["__id", "__th", "n_words", "spans", "items"])


def contamination(hits: DataFrame) -> DataFrame:
    """``__id, __th, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, sha = [], [], []
            for spans, items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
                n_hit.append(_covered(spans))
                names = sorted(set(items))
                n_items.append(len(names))
                sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__th"), batch.column("n_words"), pa.array(n_hit, pa.int64()),
                 pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_())],
                names=["__id", "__th", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    id_type = hits.schema["__id"].dataType.simpleString()
    return hits.select("__id", "__th", "n_words", "spans", "items").mapInArrow(
        run, f"__id {id_type}, __th bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def _covered(spans: list) -> int:
    total, reach = 0, 0
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def proximity_hits(index: DataFrame, queries: list[str], slop: int) -> DataFrame:
    """``(query, __id, position)``: number of the query, document, and word position of its rarest term."""
    coded = [words_of([q], ALNUM)[0] for q in queries]
    if sum(c.nbytes for c in coded) > QUERY_BYTES:
        raise ValueError("queries exceed QUERY_BYTES; pass them in several calls")
    shared = index.sparkSession.sparkContext.broadcast(coded)
    id_type = index.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                seg = Segment(_row(batch, i))
                for q, terms in enumerate(shared.value):
                    at = seg.near(np.unique(terms), slop) if len(terms) else np.empty(0, np.int64)
                    doc = np.searchsorted(seg.starts, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), q, np.int32)), seg.docs.take(pa.array(doc)), pa.array(at - seg.starts[doc], pa.int64())],
                        names=["query", "__id", "position"])

    return index.mapInArrow(common.tidied(run), f"query int, __id {id_type}, position bigint")


def decontaminate(df: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``df`` that hold no window of any item."""
    found = contamination(phrase_hits(build_index(df, id_col=id_col, text_col=text_col), items, **options))
    bad = common.materialize(found.filter("contaminated").select("__id", "__th").distinct(), "contaminated")
    return common.join_flags(df, bad, id_col, text_col, "left_anti")

"""Token ids as Parquet list columns.

Layout of a token table: one Parquet file per shard, documents in ascending id
order across and inside shards.  Columns ``doc_id``, ``shard``, ``pos`` (row in the
shard), ``n_tokens`` and ``ids`` (list of int).  ``ids`` is dictionary encoded
(a vocabulary fits one dictionary page), the monotone columns are delta encoded
(version-2 pages), row groups and pages have fixed sizes, and page indexes are
written, so one document's ids or only the metadata can be read without the rest.

Documents are range-partitioned by id as text (one shuffle) and encoded after
that, in file order, so the ids themselves never move.

Encoding calls the ``tokenizers`` library once per distinct piece between ASCII
white space and keeps the answers in a bounded table per worker, by the pieces'
64-bit ids.  This gives the same ids as encoding whole texts, because the tokenizer
drops white space and neither its normaliser nor its splitter looks across it.

Defined results: a null text is empty (only the end id); null ids sort first;
rows with the same id are ordered by text hash and each keeps its own entry; an
empty table gives an empty token table.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytewords, common

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 128 << 10
#: Pieces kept per worker (some 50 bytes each); when the table is full, the half found least often goes.
MEMO_PIECES = 1_000_000
#: Longer pieces are encoded but not kept.
MEMO_PIECE_BYTES = 48
#: Text encoded together.
BATCH_BYTES = 1 << 20

# ASCII punctuation (but an apostrophe) between a letter of Latin-1 and white space is one token of its own
_POINT = bytewords.word_table([b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27])
_LETTER = bytewords.word_table(range(0x61, 0x7B))
_LETTER_C3 = bytewords.word_table({*range(0x80, 0xC0)} - {0x97, 0xB7})  # after 0xC3


def point_starts(a: np.ndarray) -> np.ndarray:
    """Starts of the runs of punctuation that stand between a letter and a space, line feed or the end."""
    start, end = bytewords.spans(a, _POINT)
    after = np.append(a, np.uint8(0x0A))[end]
    keep = (start > 0) & ((after == 0x20) | (after == 0x0A))
    start = start[keep]
    before = a[start - 1]
    accented = _LETTER_C3[before] & (start > 1) & (a[np.maximum(start - 2, 0)] == 0xC3)
    return start[_LETTER[before] | accented]


def _gather(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[b:b + n]`` of every (b, n), end to end."""
    return flat[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


def _put(a: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``a`` with ``values`` from ``at`` on, longer if need be."""
    end = at + len(values)
    if end > len(a):
        a, old = np.zeros(end * 3 // 2, a.dtype), a
        a[:at] = old[:at]
    a[at:end] = values
    return a


class PieceTable:
    """Ids of at most ``MEMO_PIECES`` pieces, by the pieces' 64-bit ids."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        #: sorted, and the row of each
        self.keys, self.rows = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.sizes, self.begin, self.hits, self.flat = (np.empty(0, np.int32) for _ in range(4))
        self.used = 0

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each of the distinct ``keys``, -1 for one not held."""
        found = np.full(len(keys), -1, np.int64)
        if len(self):
            order = np.argsort(keys)  # neighbours are searched one after the other
            at = np.minimum(np.searchsorted(self.keys, keys[order]), len(self) - 1)
            same = self.keys[at] == keys[order]
            found[order[same]] = self.rows[at[same]]
            self.hits[found[order[same]]] += 1
        return found

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and how many each has."""
        sizes = self.sizes[rows]
        return _gather(self.flat, self.begin[rows], sizes), sizes

    def add(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Pieces not held so far."""
        if len(self) + len(keys) > MEMO_PIECES:
            often = np.argsort(-self.hits[self.rows], kind="stable")[:MEMO_PIECES // 2]
            rows = self.rows[often]
            kept = self.keys[often], *self.ids(rows), self.hits[rows] // 2
            self._clear()
            self._append(*kept)
        if len(self) + len(keys) <= MEMO_PIECES:
            self._append(keys, flat, sizes, np.zeros(len(keys), np.int32))

    def _append(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray, hits: np.ndarray) -> None:
        n = len(self)
        self.sizes, self.hits = _put(self.sizes, n, sizes), _put(self.hits, n, hits)
        self.begin = _put(self.begin, n, self.used + np.cumsum(sizes) - sizes)
        self.flat = _put(self.flat, self.used, flat)
        self.used += len(flat)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.rows = np.insert(self.keys, at, keys[order]), np.insert(self.rows, at, n + order)


class PieceEncoder:
    """Whole-text encoding by memoised white-space-free pieces."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.memo = PieceTable()
        #: the tokenizer's own model, and its spelling of letters for which its other steps do nothing else
        self.model = self.tok.model
        self.spelling = {}
        for c in map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]):
            if self.tok.normalizer.normalize_str(c) == c and len(word := self.tok.pre_tokenizer.pre_tokenize_str(c)) == 1:
                self.spelling[ord(c)] = word[0][0]
        self.letters = re.compile("[" + "".join(map(chr, self.spelling)) + "]+")

    def _encode_new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and how many each has.  A piece of lower-case Latin-1 letters is one word,
        so the tokenizer's model alone encodes it (half the time); other pieces go through the whole tokenizer."""
        out: list[list[int]] = [[]] * len(pieces)
        rest, word, model, spelling = [], self.letters.fullmatch, self.model.tokenize, self.spelling
        for i, p in enumerate(pieces):
            t = p.decode("utf-8", "replace")
            if word(t):
                out[i] = [x.id for x in model(t if t.isascii() else t.translate(spelling))]
            else:
                rest.append((i, t))
        for at in range(0, len(rest), 2048):
            part = rest[at:at + 2048]
            for (i, _), e in zip(part, self.tok.encode_batch([t for _, t in part], add_special_tokens=False), strict=True):
                out[i] = e.ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(itertools.chain.from_iterable(out), np.int32, sizes.sum()), sizes

    def encode(self, texts: list) -> list[np.ndarray]:
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        # special tokens are matched before lower-casing, and a combining mark composes with the case it follows
        plain = np.array([b"<|" not in d and b"\xcc" not in d and b"\xcd" not in d for d in data], bool)
        raw = b"\n".join([d.lower() if p else d for d, p in zip(data, plain.tolist(), strict=True)])
        edges = np.cumsum([0, *(len(d) + 1 for d in data)])
        a = np.frombuffer(raw, np.uint8)
        starts, ends = bytewords.spans(a, bytewords.NONSPACE)
        points = point_starts(a)
        if not plain.all():
            points = points[plain[np.searchsorted(edges, points, side="right") - 1]]
        starts, ends = np.sort(np.concatenate([starts, points])), np.sort(np.concatenate([ends, points]))
        # equal pieces of the batch are looked up once
        coded = pa.array(bytewords.span_ids(bytewords.prefix(a), starts, ends)).dictionary_encode()
        keys, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        rows = self.memo.find(keys)
        held, new = np.flatnonzero(rows >= 0), np.flatnonzero(rows < 0)
        flat, sizes = self.memo.ids(rows[held])
        place = np.empty(len(keys), np.int64)
        place[held] = np.arange(len(held))
        if len(new):
            first = np.empty(len(keys), np.int64)
            first[which[::-1]] = np.arange(len(which))[::-1]
            begin, end = starts[first[new]], ends[first[new]]
            new_flat, new_sizes = self._encode_new([raw[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)])
            short = end - begin <= MEMO_PIECE_BYTES
            self.memo.add(keys[new][short], new_flat[np.repeat(short, new_sizes)], new_sizes[short])
            place[new] = len(held) + np.arange(len(new))
            flat, sizes = np.concatenate([flat, new_flat]), np.concatenate([sizes, new_sizes])
        at = place[which]
        n = sizes[at]
        out = _gather(flat, (np.cumsum(sizes) - sizes)[at], n)
        cut = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, edges)]
        return [out[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(name: str, shared) -> PieceEncoder:
    """One encoder per worker process and vocabulary (``name`` is its digest)."""
    if name not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS.clear()
        _ENCODERS[name] = PieceEncoder(shared.value)
    return _ENCODERS[name]


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode_rows(df: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``(_id, _text)`` rows, already in file order, to token rows."""
    id_type = df.schema["__id"].dataType
    vocabulary = Path(tokenizer_path).read_text(encoding="utf-8")  # a few MB
    name = hashlib.sha256(vocabulary.encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, pos, enc = TaskContext.get().partitionId(), 0, encoder(name, shared)
        end = np.array([end_id], np.int32)
        for batch in batches:
            at = 0
            for texts in common.blocks(batch.column("__text").to_pylist(), lambda t: len(t or ""), BATCH_BYTES):
                ids = [np.concatenate([x, end]) for x in enc.encode(texts)]
                n = len(ids)
                part = batch.slice(at, n)
                at += n
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), pa.array(np.full(n, shard, np.int32)),
                     pa.array(np.arange(pos, pos + n, dtype=np.int64)),
                     pa.array(np.array([len(x) for x in ids], np.int64)), _list_array(ids)],
                    names=["doc_id", "shard", "pos", "n_tokens", "ids"])
                pos += n

    return df.mapInArrow(common.tidied(run), f"doc_id {id_type.simpleString()}, shard int, pos bigint, n_tokens bigint, ids array<int>")


def write_tokens(df: DataFrame, path: str, *, tokenizer_path: str, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> str:
    """Encode every text of ``df`` and write the token table to ``path``."""
    rows = common.keyed(df, id_col, text_col)
    rows = rows.repartitionByRange(shards, "__id", "__th") if shards else rows.repartitionByRange("__id", "__th")
    rows = rows.sortWithinPartitions("__id", "__th").select("__id", "__text")
    (encode_rows(rows, tokenizer_path, end_id).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "v2")
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#pos", "false")
     .parquet(path))
    return path


def read_tokens(spark: SparkSession, path: str, *, columns: list[str] | None = None, doc_ids: list | None = None) -> DataFrame:
    """Selective read: only the named columns, only the pages that hold ``doc_ids``."""
    df = spark.read.parquet(path)
    if doc_ids is not None:
        df = df.filter(F.col("doc_id").isin(doc_ids))
    return df.select(*columns) if columns else df


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a token table: where its ids start, how many they
    are and their checksum.  Offsets come from per-shard totals (one row per file)
    plus a running sum inside each shard, so no task sees more than a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            offs = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), batch.column("pos"),
                 pa.array((offs[1:] - offs[:-1]).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "shard", "pos", "n_tokens", "ids_crc32"])

    stored = spark.read.parquet(path).select("doc_id", "shard", "pos", "ids")
    id_type = stored.schema["doc_id"].dataType.simpleString()
    rows = stored.mapInArrow(common.tidied(run), f"doc_id {id_type}, shard int, pos bigint, n_tokens bigint, ids_crc32 bigint")
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(base, F.col("shard") == F.col("_shard"))
            .select("doc_id", (F.col("_base") + F.col("_in")).cast("long").alias("start"), "n_tokens", "ids_crc32"))

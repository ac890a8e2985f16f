"""Ranked lexical search with no random access (NRA).

The index holds one row per segment of documents: for every term of the segment the
posting list of (document, impact), sorted by falling impact.  A document's impact
for a term is its integer term score without the term's weight, so one order serves
every query.

A search reads the lists of a query's terms in parallel, from the top, a deeper
stretch each round.  What has been read is a document's lower score; lists in which it
was not seen yet can add at most the impact at which they stand, which gives the
upper score.  A document is dropped when its upper score is below the k-th best lower
score (of the segment, and of the segments that the task read before).  Reading goes on
until no unseen document can enter and lower and upper scores of all that are left
are equal, so membership, ties and scores are final.  Every task sends its k best per
query; a ranking by query merges them.

Segments are cut by bytes of text, queries are sent in blocks of ``QUERY_BYTES``, and
a worker's state is one segment's arrays plus k entries per query.

Defined results: null and empty texts have no terms (as documents they are not
counted, as items they get no rows); a document whose terms all weigh 0 has score
0 and no rank; repeated documents are ranked each; repeated items each get their own ranking
unless id and text are equal, which is one item; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from . import common
from .bytewords import ALNUM, words_of

#: Bytes of text of one segment (its lists are some 8 bytes per distinct word of a document).
SEGMENT_BYTES = 4 << 20
#: Bytes that a document counts besides its text: a search holds a table of its terms by the segment's documents.
DOC_BYTES = 512
#: Bytes of query text sent to the tasks at once.
QUERY_BYTES = 4 << 20
#: Postings of each list read in the first round; every round reads twice as many.
FIRST_DEPTH = 16
#: Task results of a query are first merged in so many groups, so no window holds all tasks' rows.
MERGE_GROUPS = 64

# ---- fixed values: the ranking function ----
WEIGHT_SCALE = 1000
UNIT = 1_000_000_000
TF_SCALE, LENGTH_SCALE = 1000, 12
LENGTH_PERCENT = 25
# ---- end of fixed values ----

#: The same words as ``bytewords.ALNUM`` after lower-casing A-Z, for counting.
WORD_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LISTS = "terms array<bigint>, ends array<int>, posting_docs array<int>, impacts array<int>"


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, terms with repeats)."""
    n = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_RE)).cast("long"), F.lit(0))
    row = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return row["docs"], row["terms"]


def impacts_of(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Score of ``tf`` occurrences in a document of ``n`` terms, before the term's weight."""
    m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // n_terms
    return (UNIT * tf) // (TF_SCALE * tf + LENGTH_SCALE * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, int]:
    """The stored index, the number of documents with a term and the number of terms."""
    n_docs, n_terms = corpus_size(docs, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = _Collector(n_docs, n_terms)
        for batch in batches:
            texts, at = batch.column("__text").to_pylist(), 0
            for part in common.blocks(texts, lambda t: len(t or "") + DOC_BYTES):
                seg.add(batch.column("__id").slice(at, len(part)), part)
                at += len(part)
                if seg.bytes >= SEGMENT_BYTES:
                    yield seg.row()
        if seg.ids:
            yield seg.row()

    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    index = rows.mapInArrow(common.tidied(run), f"ids array<{id_type}>, {LISTS}")
    return common.materialize_wide(index, "impact-lists"), n_docs, n_terms


class _Collector:
    """Postings of the texts added since the last row."""

    def __init__(self, n_docs: int, n_terms: int):
        self.size = (n_docs, max(n_terms, 1))
        self._clear()

    def _clear(self) -> None:
        self.ids, self.parts, self.docs, self.bytes = [], [], 0, 0

    def add(self, ids: pa.Array, texts: list) -> None:
        words, counts = words_of(texts, ALNUM)
        doc = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
        order = np.lexsort((doc, words))
        words, doc = words[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])])) if len(words) else np.empty(0, np.int64)
        tf = np.diff(np.append(new, len(words)))
        impact = impacts_of(tf.astype(np.int64), counts[doc[new]], *self.size).astype(np.int32)  # at most UNIT / TF_SCALE
        self.parts.append((words[new], (doc[new] + self.docs).astype(np.int32), impact))
        self.ids.append(ids)
        self.docs += len(texts)
        self.bytes += sum(len(t or "") + DOC_BYTES for t in texts)

    def row(self) -> pa.RecordBatch:
        terms, docs, impact = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((docs, -impact, terms))
        terms, docs, impact = terms[order], docs[order], impact[order]
        last = np.flatnonzero(np.append(terms[1:] != terms[:-1], True)) if len(terms) else np.empty(0, np.int64)
        cols = [pa.concat_arrays(self.ids), pa.array(terms[last].view(np.int64)), pa.array((last + 1).astype(np.int32)),
                pa.array(docs), pa.array(impact)]
        self._clear()
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cols],
                                          names=["ids", "terms", "ends", "posting_docs", "impacts"])


def _list(batch: pa.RecordBatch, name: str, i: int) -> pa.Array:
    return batch.column(name)[i].values


def document_frequencies(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the (sorted, distinct) terms; at most one row per term and task moves."""
    shared = index.sparkSession.sparkContext.broadcast(terms)  # at most QUERY_BYTES of query text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                have = _list(batch, "terms", i).to_numpy().view(np.uint64)
                size = np.diff(_list(batch, "ends", i).to_numpy(), prepend=0)
                at = np.searchsorted(have, wanted)
                found = at < len(have)
                found[found] = have[at[found]] == wanted[found]
                total[found] += size[at[found]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    counted = index.select("terms", "ends").mapInArrow(common.tidied(run), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    return {int(terms[r["term"]]): r["df"] for r in counted.collect()}


class Segment:
    def __init__(self, batch: pa.RecordBatch, i: int):
        self.ids = _list(batch, "ids", i)
        self.terms = _list(batch, "terms", i).to_numpy().view(np.uint64)
        self.ends = _list(batch, "ends", i).to_numpy().astype(np.int64)
        self.docs = _list(batch, "posting_docs", i).to_numpy()
        self.impacts = _list(batch, "impacts", i).to_numpy().astype(np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places in the segment) and final scores of all that may belong to
        the k best, given that k documents elsewhere have ``floor`` or more (0: none known)."""
        at = np.searchsorted(self.terms, terms)
        there = at < len(self.terms)
        there[there] = self.terms[at[there]] == terms[there]
        at, weights = at[there], weights[there]
        stop = self.ends[at]
        cur = np.where(at > 0, self.ends[at - 1], 0)
        stands = weights * self.impacts[cur]  # what the next posting of each list adds
        lower = np.zeros(len(self.ids), np.int64)
        seen = np.zeros((len(at), len(self.ids)), bool)
        live = np.empty(0, np.int64)  # documents read so far that may still belong
        need, entry, depth = max(floor, 1), True, FIRST_DEPTH
        while len(stands) and stands.any():
            if int(stands.sum()) < need:
                entry = False  # no unseen document can enter any more
                if not len(live):
                    break
            n = np.minimum(depth, stop - cur)
            lists = np.repeat(np.arange(len(cur)), n)
            place = np.repeat(cur - (np.cumsum(n) - n), n) + np.arange(len(lists))
            docs = self.docs[place]
            if not entry:  # sequential reads go on, but only for the documents that are left
                mine = np.isin(docs, live)
                lists, place, docs = lists[mine], place[mine], docs[mine]
            np.add.at(lower, docs, weights[lists] * self.impacts[place])
            seen[lists, docs] = True
            cur = cur + n
            more = cur < stop
            stands = np.where(more, weights * self.impacts[np.where(more, cur, 0)], 0)
            if entry:
                live = np.flatnonzero(seen.any(axis=0))
            if len(live) >= k:
                need = max(need, int(np.partition(lower[live], -k)[-k]))
            rest = stands.sum() - stands @ seen[:, live]
            stay = lower[live] + rest >= need
            live, rest = live[stay], rest[stay]
            if not entry and not rest.any():
                break  # all that are left have their final scores
            depth *= 2
        live = live[lower[live] >= need]
        return live, lower[live]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id (nulls first)."""
    values = ids.tolist()
    null = np.array([x is None for x in values], bool)
    blank = next((type(x)() for x in values if x is not None), 0)
    keys = np.array([blank if x is None else x for x in values])
    return np.lexsort((keys, ~null, -scores))[:k]


def _task_best(batches: Iterator[pa.RecordBatch], queries: list, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of a task per query.  ``queries``: (number, sorted distinct terms, weight times repeats of each)."""
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field("ids").type.value_type
        for i in range(batch.num_rows):
            seg = Segment(batch, i)
            for q, terms, weights in queries:
                scores, ids = best.get(q, (np.empty(0, np.int64), np.empty(0, object)))
                floor = int(scores[-1]) if len(scores) == k else 0
                places, found = seg.search(terms, weights, k, floor)
                if len(places):
                    ids = np.concatenate([ids, np.array(seg.ids.take(pa.array(places)).to_pylist(), object)])
                    scores = np.concatenate([scores, found])
                    keep = _best(scores, ids, k)
                    best[q] = (scores[keep], ids[keep])
    if best:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(list(best), np.int32), [len(s) for s, _ in best.values()])),
             pa.array([x for _, ids in best.values() for x in ids.tolist()], kind),
             pa.array(np.concatenate([s for s, _ in best.values()]), pa.int64())], names=["query", "doc", "score"])


def _query_blocks(items: DataFrame, id_col: str, text_col: str):
    """The distinct items in blocks of about ``QUERY_BYTES``, each collected by itself."""
    rows = items.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter(F.col("__text").isNotNull()).distinct()
    size = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n = int(size // QUERY_BYTES) + 1
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("__id", "__text"), F.lit(n)) == i) if n > 1 else rows
        yield [(r["__id"], r["__text"]) for r in part.collect()]


def search(index: DataFrame, n_docs: int, items: DataFrame, *, k: int = 20, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of every item with a score above 0."""
    spark = index.sparkSession
    out = None
    item_type = items.schema[item_id].dataType
    doc_type = index.schema["ids"].dataType.elementType
    for block in _query_blocks(items, item_id, item_text):
        words, counts = words_of([t for _, t in block], ALNUM)
        frequency = document_frequencies(index, np.unique(words))
        queries, at = [], 0
        for q, n in enumerate(counts.tolist()):
            terms, repeats = np.unique(words[at:at + n], return_counts=True)
            at += n
            w = np.array([weight(frequency[int(t)], n_docs) if int(t) in frequency else 0 for t in terms], np.int64)
            if (w > 0).any():
                queries.append((q, terms[w > 0], (w * repeats)[w > 0]))
        shared = spark.sparkContext.broadcast(queries)
        found = index.mapInArrow(common.tidied(lambda batches, shared=shared: _task_best(batches, shared.value, k)),
                                 f"query int, doc {doc_type.simpleString()}, score bigint")
        first = Window.partitionBy("query", "group").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
        found = found.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k)
        last = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
        ranked = found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
        if not block:
            continue
        names = spark.createDataFrame([(q, x) for q, (x, _) in enumerate(block)], _names_schema(item_type))
        part = ranked.join(F.broadcast(names), "query").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")  # at most QUERY_BYTES of items
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id {doc_type.simpleString()}, score bigint")
    return out


def _names_schema(item_type) -> StructType:
    return StructType([StructField("query", IntegerType()), StructField("item_id", item_type)])

"""Filter interaction audit by a Gray-code subset walk.

What a chain of filters removes at each step depends on their order.  Every
document fails some set of the filters (its mask), so per part of the corpus
``2**m`` cells of counts hold all that any order can show.  The walk visits every
set of active filters once, in Gray-code order: one filter is toggled at a time,
each cell's counter of active failed filters goes up or down by one, and cells
whose counter reaches or leaves zero leave or join the running survivors.  The
survivors of each set are stored; every step of every order is a difference of
two of these states.

Work: one pass over the texts (native expressions), one aggregation by text hash for the
copies, one by (part, mask); then one row of cells per part goes through the walk.
No row of a document meets another document's row, so a source or a group of
copies with a third of all rows is summed in its tasks before it moves.

Defined results: null texts are empty; a null part is the empty string; a null id
is neither smaller nor larger than another, so such rows are never copies and make
no copies; rows that repeat an id and a text count each; an id with several labels
is good (toxic) if one of them says so; no rows, no result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# ---- fixed values: the five filters' thresholds ----
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
# ---- end of fixed values ----

#: All orders are reported, so their number bounds the filters.
MAX_FILTERS = 6
COUNTS = ("n", "good", "toxic")
RESULT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
          "good_lost bigint, toxic_lost bigint, shapley bigint")


def text_filters(text: Column) -> dict[str, Column]:
    """Letter -> failure condition, for the filters that see one text alone."""
    t = F.coalesce(text, F.lit(""))
    # one array of words serves both conditions
    counts = F.transform(F.array(F.regexp_extract_all(t, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))),
                         lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    return {"words": counts, "capitals": F.regexp_count(t, F.lit("[A-Z]")), "length": F.length(t), "symbols": t.rlike(SYMBOLS)}


def failures(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``(id, hash, part, mask, good, toxic)`` per document; bit i of ``mask``: fails filter i of A-D.
    ``hash`` names the text for the copies (E).  Written once: the text is read a single time."""
    m = text_filters(F.col("__text"))
    measured = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(part_col).alias("__part")).select(
        "__id", F.unhex(F.sha2(F.coalesce("__text", F.lit("")), 256)).alias("__hash"), F.coalesce("__part", F.lit("")).cast("string").alias("part"),
        m["words"].alias("w"), m["capitals"].alias("caps"), m["length"].alias("len"), m["symbols"].alias("sym"))
    fails = [F.col("w.n") < MIN_WORDS, 100 * F.col("w.d") < MIN_DISTINCT_PERCENT * F.col("w.n"),
             100 * F.col("caps").cast("long") > MAX_CAPITALS_PERCENT * F.col("len"), F.col("sym")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    rows = common.materialize(measured.select("__id", "__hash", "part", mask.cast("int").alias("mask")), "filter-masks")
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__lid")).agg(
        flag("quality").alias("good"), flag("toxic").alias("toxic"))
    zero = F.lit(0).cast("long")
    return rows.join(marks, F.col("__id") == F.col("__lid"), "left").select(
        "__id", "__hash", "part", "mask", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic"))


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """Cells ``(part, mask, n, good, toxic)``; ``bit`` is set for texts that a smaller id has too.

    First holders (the rows of a text's smallest id) are found by an aggregation per
    text and met by (text, id); all other rows of the text are its total less those.
    Nothing is joined by the text alone, whose copies may be a third of all rows."""
    sums = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    total = rows.groupBy("part", "mask").agg(*sums)
    first = rows.filter("__id IS NOT NULL").groupBy("__hash").agg(F.min("__id").alias("__first")).withColumnRenamed("__hash", "__fh")
    held = rows.filter("__id IS NOT NULL").join(first, (F.col("__hash") == F.col("__fh")) & (F.col("__id") == F.col("__first")))
    kept = held.select("part", "mask", "good", "toxic").unionAll(rows.filter("__id IS NULL").select("part", "mask", "good", "toxic")) \
        .groupBy("part", "mask").agg(*sums)
    less = kept.select("part", (F.col("mask") + (1 << bit)).alias("mask"), *[(-F.col(c)).alias(c) for c in COUNTS])
    both = kept.unionByName(total.withColumn("mask", F.col("mask") + (1 << bit))).unionByName(less)
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def gray_states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every set of active filters.  ``cells[..., mask, count]`` holds the
    documents by mask; the result has the active set in place of the mask."""
    size = cells.shape[-2]
    states = np.zeros_like(cells)
    failed = np.zeros(size, np.int64)  # active filters that a cell fails
    alive = cells.sum(axis=-2)
    active = 0
    states[..., 0, :] = alive
    for i in range(1, size):
        bit = i & -i  # the filter that the Gray code toggles
        active ^= bit
        touched = (np.arange(size) & bit) > 0
        if active & bit:
            gone = touched & (failed == 0)
            failed[touched] += 1
            alive = alive - cells[..., gone, :].sum(axis=-2)
        else:
            failed[touched] -= 1
            back = touched & (failed == 0)
            alive = alive + cells[..., back, :].sum(axis=-2)
        states[..., active, :] = alive
    return states


def _orders(letters: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All orders; per order and step the filter, the set before and the set after."""
    orders = list(itertools.permutations(range(len(letters))))
    which = np.array(orders, np.int64)
    after = np.cumsum(1 << which, axis=1)
    return ["".join(letters[i] for i in o) for o in orders], which, after - (1 << which), after


def step_rows(cells: np.ndarray, letters: str) -> dict[str, np.ndarray]:
    """Counts of every order and step (flat, orders first) from one part's cells."""
    names, which, before, after = _orders(letters)
    states = gray_states(cells)
    size = cells.shape[0]
    lost = states[before] - states[after]  # order, step, count
    m = len(letters)
    failing = np.array([cells[(np.arange(size) >> f & 1) > 0, 0].sum() for f in range(m)])
    alone = np.array([states[(size - 1) ^ (1 << f), 0] - states[size - 1, 0] for f in range(m)])
    shapley = np.zeros(m, np.int64)
    np.add.at(shapley, which.ravel(), lost[..., 0].ravel())
    return {"kept": states[after][..., 0].ravel(), "removed": lost[..., 0].ravel(), "redundant": (failing[which] - lost[..., 0]).ravel(),
            "unique_fails": alone[which].ravel(), "good_lost": lost[..., 1].ravel(), "toxic_lost": lost[..., 2].ravel(),
            "shapley": shapley[which].ravel()}


def walk(cells: DataFrame, letters: str) -> DataFrame:
    """Cells of every part to one row per part, order and step.  At most ``2**m`` cells of a part meet."""
    m = len(letters)
    if not 1 <= m <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {m}")
    parts = cells.groupBy("part").agg(*[F.collect_list(F.struct("mask", c)).alias(c) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, which, _, _ = _orders(letters)
        order = pa.array(np.repeat(names, m))
        step = pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(names)))
        for batch in batches:
            for row in batch.to_pylist():
                table = np.zeros((1 << m, len(COUNTS)), np.int64)
                for k, c in enumerate(COUNTS):
                    for x in row[c]:
                        table[x["mask"], k] += x[c]
                out = step_rows(table, letters)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(step), pa.string()), order, step, *[pa.array(v, pa.int64()) for v in out.values()]],
                    names=["part", "filter_order", "step", *out])

    return parts.mapInArrow(run, RESULT)


def audit(docs: DataFrame, labels: DataFrame, **cols) -> DataFrame:
    """The five filters A-E over whole texts, all 120 orders, per part."""
    return walk(with_copies(failures(docs, labels, **cols), bit=4), "ABCDE")

"""Mixing sources to target weights by Pareto order sampling.

1. Sizes: words per document, then one row per source (sizes add as integers).
2. Targets: sources in code-point order (null last) take the weights in turn and
   share ``budget`` x all sizes; a target stops at ``cap`` times its source's size
   and the excess is shared again by weight.  In closed form: sort sources by the
   level at which they reach their cap; the common level follows from prefix sums.
3. Whole copies: every document is certain floor(target / source size) times.
4. The rest is a Pareto order sample: a document with inclusion probability p and a
   uniform number u (a hash of its id) ranks by (u / (1-u)) / (p / (1-p)), and each
   source takes its lowest ranks until the words of the remainder are reached.
   p is the source's fractional rate times an optional weight of the document.

The ranking needs no sort of a whole source: ranks are cut into ``BINS`` equal
slices of (0, 1), words per (source, slice) are summed with map-side combine, and
only documents of the one slice in which a source's remainder ends are ordered.

Defined results: a null text has size 0 and is never taken; null sources are one
source; rows equal in id and size are taken together (a null id
is replaced by a hash of its text); a source's words
differ from its target by at most half its boundary document (plus rounding); an empty table
gives no rows.  All steps are DataFrame expressions, and reruns agree exactly
because sums are of integers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORD = r"[^\x20\x09-\x0D]+"
BINS = 1 << 14


def uniform(key: Column, seed: str = "mix") -> Column:
    """A number in (0, 1) from 52 bits of an MD5 of the key; null is a key too."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, *, weights: Sequence[float], budget: float, cap: float) -> DataFrame:
    """``(source, source_size)`` rows (one per source, far fewer than documents) to
    ``(source, source_size, target)``."""
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    below = Window.orderBy("_level", "_i").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("source_size").cast("double")
    return (sources.withColumn("_i", F.row_number().over(turn) - 1)
            .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                           (F.col("_i") % len(weights) + 1).cast("int")))
            .withColumn("_cap", size * cap)
            .withColumn("_level", F.col("_cap") / F.col("_w"))
            .withColumn("_budget", F.sum("source_size").over(total).cast("double") * budget)
            .withColumn("_wsum", F.sum("_w").over(total))
            # if all lower levels are at their cap, the rest shares what is left by weight
            .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(below), F.lit(0.0)))
            .withColumn("_wleft", F.col("_wsum") - F.coalesce(F.sum("_w").over(below), F.lit(0.0)))
            .withColumn("_open", F.col("_left") < F.col("_level") * F.col("_wleft"))
            .withColumn("_first", F.min(F.when(F.col("_open"), F.struct("_level", "_i", "_left", "_wleft"))).over(total))
            .withColumn("target", F.when(F.col("_open"), F.col("_first._left") * F.col("_w") / F.col("_first._wleft"))
                        .otherwise(F.col("_cap")))
            .select("source", "source_size", "target"))


def mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0,
        weight_col: str | None = None, seed: str = "mix") -> DataFrame:
    """All rows of ``df`` plus ``size``, ``source_size``, ``target``, ``copies`` and ``taken``
    (words: ``copies`` x ``size``).  ``weight_col`` (positive) makes inclusion unequal inside a source."""
    added = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in df.columns if c not in added]
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col)))
    rows = df.withColumns({
        "__size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"),
        "__u": uniform(key, seed),
        "__source": F.col(source_col),
        "__w": F.col(weight_col).cast("double") if weight_col else F.lit(1.0)})
    narrow = common.materialize(rows.select("__source", "__size", "__u", "__w"), "mix-sizes")
    sizes = narrow.groupBy(F.col("__source").alias("source")).agg(
        F.sum("__size").alias("source_size"), F.sum(F.col("__w") * F.col("__size")).alias("_wwords"))
    plan = source_targets(sizes.select("source", "source_size"), weights=weights, budget=budget, cap=cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (plan.join(sizes.select(F.col("source").alias("_s"), "_wwords"), F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("_whole", F.floor(rate).cast("long"))
            .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
            # expected words of the remainder: the sum of p x size is the rest
            .withColumn("_p", F.when(F.col("_wwords") > 0, F.col("_rest") / F.col("_wwords")).otherwise(0.0))
            .select(F.col("source").alias("_source"), "source_size", "target", "_whole", "_rest", "_p"))
    plan = common.materialize(plan, "mix-plan")

    def ranked(data: DataFrame, plan: DataFrame) -> DataFrame:
        p = F.least(F.greatest(F.col("_p") * F.col("__w"), F.lit(1e-12)), F.lit(1 - 1e-12))
        odds = (F.col("__u") / (1 - F.col("__u"))) / (p / (1 - p))
        return (data.join(plan, F.col("__source").eqNullSafe(F.col("_source")))
                .withColumn("_rank", odds / (1 + odds))  # the Pareto rank, brought to (0, 1); monotone
                .withColumn("_bin", F.floor(F.col("_rank") * BINS).cast("int")))

    # the slice in which each source's remainder ends
    run = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = (ranked(narrow, plan).groupBy("_source", "_rest", "_bin").agg(F.sum("__size").alias("_words"))
            .withColumn("_from", F.coalesce(F.sum("_words").over(run), F.lit(0)))
            .filter((F.col("_from") < F.col("_rest")) & (F.col("_from") + F.col("_words") >= F.col("_rest")))
            .select(F.col("_source").alias("_s"), F.col("_bin").alias("_end"), "_from"))
    plan = common.materialize(plan.join(ends, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-ends")
    # inside that slice, documents are taken while their middle lies before the end (equal ranks together)
    inside = Window.partitionBy("_source").orderBy("_rank", "__size").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (ranked(narrow, plan).filter(F.col("_bin") == F.col("_end"))
            .groupBy("_source", "_rest", "_from", "_rank", "__size").agg(F.sum("__size").alias("_words"))
            .withColumn("_before", F.col("_from") + F.coalesce(F.sum("_words").over(inside), F.lit(0)))
            .filter(F.col("_before") + F.col("_words") / 2 <= F.col("_rest"))
            .groupBy(F.col("_source").alias("_s")).agg(F.max(F.struct("_rank", "__size")).alias("_cut")))
    plan = common.materialize(plan.join(cuts, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-cuts")
    extra = (F.col("_bin") < F.col("_end")) | (
        (F.col("_bin") == F.col("_end")) & (F.struct("_rank", "__size") <= F.col("_cut")))
    copies = F.when(F.col("__size") > 0, F.col("_whole") + F.when(extra, 1).otherwise(0)).otherwise(0).cast("long")
    return (ranked(rows, plan).withColumn("__copies", copies)
            .select(*keep, F.col("__size").alias("size"), F.col("source_size").cast("long").alias("source_size"),
                    "target", F.col("__copies").alias("copies"), (F.col("__copies") * F.col("__size")).alias("taken")))


def take(df: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, with its columns as they are."""
    safe = {c: f"__in{i}" for i, c in enumerate(df.columns)}
    options = {k: safe[v] for k, v in ({"id_col": "doc_id", "text_col": "text", "source_col": "source"} | options).items()
               if k in ("id_col", "text_col", "source_col", "weight_col")} | {
        k: v for k, v in options.items() if k not in ("id_col", "text_col", "source_col", "weight_col")}
    mixed = mix(df.withColumnsRenamed(safe), **options).filter(F.col("copies") > 0)
    return (mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*[F.col(new).alias(old) for old, new in safe.items()]))

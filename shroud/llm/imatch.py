"""I-Match document fingerprints over randomised lexicons.

A document is its set of terms whose inverse document frequency lies in a band: words
that stand in very many documents say nothing, words that stand in hardly any are
often slips.  The distinct terms are sorted and hashed: once for the whole lexicon and
once for each of several random subsets of it.  A small change leaves the
hashes of those subsets alone that none of the changed terms belongs to.

The random subsets: the lexicon is dealt at random into ``GROUPS`` groups, and every group is
thinned ``LEVELS - 1`` times, each time to a random half.  Down a group, two texts agree
from the level on that none of their different terms reaches, so with e agreeing levels (that
hold any term) some 2**-e of the group's terms differ: its likeness is ``1 - 2**-e``, and 1 if
all levels agree.  The likeness of two fingerprints is the mean over the groups that hold a term
of either, and 1 for equal fingerprints.  Groups and halves are read off the terms'
64-bit hashes, so a group is a stretch of the sorted terms.

Everything is built-in expressions and joins (no Python in the tasks).  The text crosses one
shuffle, by ranges of the id, in which ``lead`` finds the next document; what follows
(terms, lexicon, sets per document) stays in that partitioning.

The lexicon: a term in the band stands in at least ``MIN_SHARE`` of the documents, so it
has at most (distinct terms of a mean document) / ``MIN_SHARE`` terms, whatever the size of the
corpus.  It is counted and broadcast up to ``BROADCAST_TERMS``; a larger one is joined by shuffle.

Defined results: a null text is empty; a text without a term in the band is fingerprinted
over all its terms, one without terms by its own hash; null ids sort first; rows with the
same id are ordered by the hash of the text and keep a row each; ids must be integers; an
empty table gives no rows; a single row's next document is itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shroud.functions.spans import let

from . import common

#: The band: terms in at most this share of the documents (idf >= 2.3) ...
MAX_SHARE = 0.1
#: ... and in at least this share (idf <= 9.2), and in two documents.
MIN_SHARE = 1e-4
MIN_DOCUMENTS = 2
#: 2**GROUP_BITS groups, by the highest bits of a term's hash; levels by its lowest bits.
GROUP_BITS = 5
GROUPS = 1 << GROUP_BITS
LEVELS = 8
#: A lexicon of so many terms (16 bytes each) is broadcast.
BROADCAST_TERMS = 1_000_000
TERM_RE = r"[\p{L}\p{M}\p{N}]+"
#: Id ranges per shuffle partition: hashed ranges fill the partitions evenly.
RANGES_PER_PARTITION = 4


def term_hashes(text: Column) -> Column:
    """Distinct terms of a text, as 64-bit hashes."""
    return F.transform(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM_RE), F.lit(0))), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term)``: hashes of the terms in the band, counted over all documents."""
    n = docs.count()
    low, high = max(MIN_DOCUMENTS, math.ceil(MIN_SHARE * n)), max(MIN_DOCUMENTS, math.floor(MAX_SHARE * n))
    terms = docs.select(F.explode(term_hashes(F.coalesce(F.col(text_col), F.lit("")))).alias("term"))
    return common.materialize(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df").between(low, high)).select("term"), "lexicon")


# ---- the next document ----
def _range_of(starts: list[int], col: str) -> str:
    """Number of the id range (0-based) that holds ``col``; two short scans instead of one over all starts."""
    width = max(1, math.isqrt(len(starts)))
    groups = [starts[i:i + width] for i in range(0, len(starts), width)]
    longs = lambda xs: "array(" + ", ".join(f"{x}L" if x > -(1 << 63) else "CAST('-9223372036854775808' AS BIGINT)" for x in xs) + ")"
    heads, tails = longs([g[0] for g in groups]), "array(" + ", ".join(longs(g) for g in groups) + ")"
    group = f"size(filter({heads}, __h -> __h <= {col})) - 1"
    return let(group, lambda g: f"{g} * {width} + size(filter(get({tails}, {g}), __s -> __s <= {col})) - 1")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(__range, __n, __id, __text, __next_range, __next_n, __next)`` of every document: its place in the order
    of ids, and place and text of the next one (after the last: of the first).

    The first rows of a range are also sent, as guests, to the range before it, so the
    last row there finds its successor without a second look at the texts."""
    spark = docs.sparkSession
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), order.alias("__o"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one number per range comes to the driver
    starts = sorted(r[0] for r in docs.select(order.alias("__o")).repartitionByRange(tasks * RANGES_PER_PARTITION, "__o")
                    .groupBy(F.spark_partition_id().alias("p")).agg(F.min("__o")).select("min(__o)").collect())
    if not starts:
        starts = [0]
    home = F.expr(_range_of(starts, "__o"))
    rows = rows.withColumn("__home", home)
    guest = F.when(F.col("__o").isin(starts), F.array(F.col("__home"), F.pmod(F.col("__home") - 1, F.lit(len(starts))))).otherwise(F.array("__home"))
    dealt = rows.select("__id", "__text", "__o", "__home", F.posexplode(guest).alias("__guest", "__range")) \
        .withColumn("__th", F.xxhash64("__text")) \
        .repartition(tasks, "__range")  # so many tasks as asked for: much work follows on few bytes
    w = Window.partitionBy("__range").orderBy("__guest", "__o", "__th")
    n = F.row_number().over(w)
    after = lambda c: F.lead(c).over(w)
    placed = dealt.select("__range", "__id", "__text", "__guest", n.alias("__n"), after("__home").alias("__next_range"),
                          after("__guest").alias("__next_guest"), after("__text").alias("__next"))
    return placed.filter("__guest = 0").select(
        "__range", "__n", "__id", "__text", "__next_range",
        F.when(F.col("__next_guest") > 0, 1).otherwise(F.col("__n") + 1).alias("__next_n"), "__next")


def edited(text: str, following: str) -> Column:
    """The last half (code points, rounded down) replaced by as much of the beginning of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), F.length(text) - half), F.substring(F.col(following), F.lit(1), half))


# ---- fingerprints ----
_NONE = "00"  # stands for a subset that holds none of the text's terms


def _levels(terms: str) -> str:
    """Hashes of a group's nested subsets, two digits each; level j holds the terms whose hash ends in j zero bits."""
    mark = f"CASE WHEN size(%s) = 0 THEN '{_NONE}' ELSE lower(lpad(hex(pmod(xxhash64(%s), 255) + 1), 2, '0')) END"
    kept = "CASE WHEN j = 0 THEN acc.a ELSE filter(acc.a, t -> getbit(t, j - 1) = 0) END"
    step = let(kept, lambda v: f"named_struct('a', {v}, 's', concat(acc.s, {mark % (v, v)}))")
    return f"aggregate(sequence(0, {LEVELS - 1}), named_struct('a', {terms}, 's', ''), (acc, j) -> {step}, acc -> acc.s)"


def fingerprint(terms: str, own_hash: str) -> Column:
    """Hash of all terms (16 digits), then the groups; ``terms`` is a sorted array, ``own_hash`` serves texts without any."""
    whole = f"lower(lpad(hex(CASE WHEN size({terms}) = 0 THEN {own_hash} ELSE xxhash64({terms}) END), 16, '0'))"
    half = GROUPS // 2

    def group(places: str) -> str:
        return let(f"array_position({places}, g)", lambda at: (
            f"CASE WHEN {at} = 0 THEN '{_NONE * LEVELS}' "
            f"ELSE {_levels(f'slice({terms}, CAST({at} AS INT), size({terms}) - size(array_remove({places}, g)))')} END"))

    groups = let(f"transform({terms}, t -> shiftright(t, {64 - GROUP_BITS}))",
                 lambda places: f"array_join(transform(sequence({-half}L, {half - 1}L), g -> {group(places)}), '')")
    return F.expr(f"concat({whole}, {groups})")


def likeness(a: str, b: str) -> Column:
    """Of two fingerprints, 0 to 1."""
    size = len(_NONE) * LEVELS
    empty = f"'{_NONE * LEVELS}'"

    def same(x: str, y: str) -> str:
        at = f"substring({x}, 2 * j + 1, 2)"
        return f"size(filter(sequence(0, {LEVELS - 1}), j -> {at} = substring({y}, 2 * j + 1, 2) AND {at} <> '{_NONE}'))"

    def group(v: str) -> str:
        return f"CASE WHEN {v}.x = {v}.y THEN CASE WHEN {v}.x <> {empty} THEN 1.0D END ELSE 1 - power(2.0D, -{same(v + '.x', v + '.y')}) END"

    cut = lambda fp: f"substring({fp}, 17 + {size} * g, {size})"
    each = let(f"named_struct('x', {cut(a)}, 'y', {cut(b)})", group)
    mean = (f"aggregate(filter(transform(sequence(0, {GROUPS - 1}), g -> {each}), z -> z IS NOT NULL), named_struct('s', 0.0D, 'n', 0), "
            "(acc, z) -> named_struct('s', acc.s + z, 'n', acc.n + 1), acc -> CASE WHEN acc.n = 0 THEN 0.0D ELSE acc.s / acc.n END)")
    return F.expr(f"CASE WHEN {a} = {b} THEN 1.0D ELSE {mean} END")


def fingerprint_pairs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every document."""
    lex = lexicon(docs, text_col)
    small = lex.count() <= BROADCAST_TERMS
    lex = lex.select(F.col("term").alias("__lt"))
    rows = with_next(docs, id_col, text_col).withColumn("__edited", edited("__text", "__next")).select(
        "__range", "__n", "__id", "__next_range", "__next_n", F.length("__text").cast("long").alias("n_chars"),
        F.unhex(F.sha2("__edited", 256)).alias("__sha"), F.xxhash64("__text").alias("__own"), F.xxhash64("__edited").alias("__eown"),
        term_hashes(F.col("__text")).alias("__tt"), term_hashes(F.col("__edited")).alias("__et"))
    key = ["__range", "__n", "__id", "__next_range", "__next_n", "n_chars", "__sha", "__own", "__eown"]
    # one row per distinct term of the two texts (1: the text's, 2: the edited one's, 3: both); a document without terms keeps one row
    marks = [(F.array_intersect("__tt", "__et"), 3), (F.array_except("__tt", "__et"), 1), (F.array_except("__et", "__tt"), 2)]
    marked_as = lambda m: lambda t: F.struct(t.alias("t"), F.lit(m).alias("of"))
    both = F.concat(*[F.transform(a, marked_as(m)) for a, m in marks])
    terms = rows.select(*key, F.explode_outer(both).alias("__p")).select(*key, "__p.t", "__p.of")
    marked = terms.join(F.broadcast(lex) if small else lex, F.col("t") == F.col("__lt"), "left")
    band = F.col("__lt").isNotNull()
    terms_of = lambda bit, which: F.sort_array(F.collect_list(F.when((F.getbit("of", F.lit(bit)) == 1) & which, F.col("t"))))
    # already partitioned by range, so the sets are made where the texts are
    sets = marked.groupBy(*key).agg(terms_of(0, band).alias("__in0"), terms_of(0, ~band).alias("__out0"),
                                    terms_of(1, band).alias("__in1"), terms_of(1, ~band).alias("__out1"))
    pick = lambda e: F.when(F.size(f"__in{e}") > 0, F.col(f"__in{e}")).otherwise(F.col(f"__out{e}"))
    sets = sets.select(*key, pick(0).alias("__t0"), pick(1).alias("__t1"))
    prints = sets.select("__range", "__n", "__id", "__next_range", "__next_n", "n_chars", F.lower(F.hex("__sha")).alias("edited_sha256"),
                         fingerprint("__t0", "__own").alias("fingerprint"), fingerprint("__t1", "__eown").alias("edited_fingerprint"))
    stored = common.materialize(prints, "fingerprints")
    following = stored.select(F.col("__range").alias("__r"), F.col("__n").alias("__m"), F.col("fingerprint").alias("__nf"))
    joined = stored.join(following, (F.col("__next_range") == F.col("__r")) & (F.col("__next_n") == F.col("__m")))
    return joined.select(F.col("__id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "__nf").alias("near_next"))

"""Near-duplicate lines by a deletion-neighbourhood join (edit distance at most ``edits``).

A line is dropped when an earlier line, kept or not, equals it or is within ``edits`` edits
(character inserted, deleted or replaced).  Earlier is by (document id, line number).
Blank lines stay; lines under ``min_chars`` characters go only for equality (1: no line is
exempt).  The defaults, ``EDITS`` and ``MIN_CHARS``, are those of the query's SQL.

Equal lines collapse first.  For one edit: of two lines one edit apart let c be the shorter length.
Variants are hashed with c and the place they leave out, in three steps, each for the lines
that the step before left with company:

1. *halves*: all but one half of c (4 keys a line); most lines end here;
2. *blocks*: all but one of about sqrt(c) blocks (2 sqrt(c) keys a line);
3. *characters*: all but one character of such a block, and for the shorter line every
   gap in which the longer one may have its extra character.

Lines that share a key of step 3 are all within one edit of each other, so a group needs no
pairs: its earliest line is joined to the others and verified by edit distance.
For more edits (k) the same steps leave out more: one of k + 1 *pieces* stays, at any place
that k edits can shift it to; all but k of the *blocks* stay, for every way to spread the shifts
over them; k *holes* in these blocks take a character or none each.  Lines that share
such a key are within k edits of each other.  The keys grow with the line to the power k.
Every step is a hash aggregation with map-side combine, so a key that
very many lines share costs one row per task.  All steps are DataFrame expressions.

Defined results: a null text has no lines; null ids come last in the order; repeated rows (same
id and text) are one document and each keeps the same lines; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

EDITS, MIN_CHARS = 1, 20
BREAK = "\n"


def _half_keys(line: Column, m: Column) -> Column:
    """Keys of step 1 for c = m (shorter or equal) and c = m - 1 (longer)."""
    keys = []
    for c in (m, m - 1):
        half = F.floor(c / 2).cast("int")
        keys += [F.xxhash64(F.lit("p"), c, F.left(line, half)), F.xxhash64(F.lit("s"), c, F.right(line, c - half))]
    return F.array(*keys)


def _shifts(edits: int) -> list[tuple[int, ...]]:
    """How much longer each of ``edits`` parts may be than in a line that is as long or shorter."""
    return [d for d in itertools.product(range(-edits, edits + 1), repeat=edits) if sum(d) >= 0 and sum(map(abs, d)) <= edits]


def _piece_keys(line: Column, m: Column, edits: int) -> Column:
    """Keys of step 1 for more than one edit: the pieces of c = m - t, shifted by s."""
    keys = []
    for t in range(edits + 1):
        c = m - t
        for s in range(-edits, edits + 1):
            if abs(s) + abs(t - s) > edits:
                continue
            for j in range(edits + 1):
                start, end = (F.floor(c * i / (edits + 1)).cast("int") for i in (j, j + 1))
                fits = (c >= 1) & (start + s >= 0) & (end + s <= m)
                keys.append(F.when(fits, F.xxhash64(F.lit(j), c, F.substr(line, start + s + 1, end - start))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def _lines(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """One row per line of ``docs(__id, __th, __text)`` that is not blank."""
    rows = docs.select("__id", "__th", F.posexplode(F.split("__text", BREAK)).alias("n", "line"))
    m = F.char_length("line")
    return rows.filter(F.trim(F.translate("line", "\t\r", "  ")) != "").select(
        F.struct(F.col("__id").isNull().alias("last"), F.col("__id").alias("id"), F.col("__th").alias("th"), F.col("n")).alias("at"),
        F.xxhash64("line").alias("h"), m.alias("m"),
        F.when(m >= min_chars, _half_keys(F.col("line"), m) if edits == 1 else _piece_keys(F.col("line"), m, edits)).otherwise(F.array().cast("array<bigint>")).alias("halves"))


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key another row has too."""
    company = rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col(key).alias("_key"))
    return rows.join(company, F.col(key) == F.col("_key"), "left_semi")


def _blocks(lines: DataFrame) -> DataFrame:
    """Step 2 keys ``g`` of ``lines(h, at, line, m)`` with the part they leave out."""
    roles = lines.withColumn("long", F.explode(F.array(F.lit(False), F.lit(True))))
    roles = roles.withColumn("c", F.col("m") - F.col("long").cast("int")).filter("c > 0").withColumn("b", F.ceil(F.sqrt("c")).cast("int"))
    cut = roles.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("b") - 1)))
    start = F.floor(F.col("j") * F.col("c").cast("long") / F.col("b")).cast("int")
    rest = F.col("c") - F.floor((F.col("j") + 1) * F.col("c").cast("long") / F.col("b")).cast("int")
    return cut.select(
        "h", "at", "long",
        F.xxhash64("c", "j", F.left("line", start), F.right("line", rest)).alias("g"),
        F.substr("line", start + 1, F.col("m") - start - rest).alias("mid"))


def _characters(blocks: DataFrame) -> DataFrame:
    """Step 3 keys of the blocks."""
    size = F.char_length("mid")
    places = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    without = lambda i: F.concat(F.left("mid", i - 1), F.substr("mid", i + 1))
    left_out = lambda kind: F.transform(places, lambda i: F.xxhash64(F.lit(kind), F.col("g"), i, without(i)))
    gaps = F.transform(F.sequence(F.lit(1), size + 1), lambda i: F.xxhash64(F.lit("gap"), F.col("g"), i, F.col("mid")))
    keys = F.when(F.col("long"), left_out("gap")).otherwise(F.concat(left_out("swap"), gaps))
    return blocks.select("h", "at", F.explode(keys).alias("key"))


def _block_sets(lines: DataFrame, edits: int) -> DataFrame:
    """Step 2 keys ``g`` for more than one edit, with the blocks they leave out (each after a line break)."""
    rows = lines.withColumn("d", F.explode(F.array(*[F.array(*map(F.lit, d)) for d in _shifts(edits)])))
    rows = rows.withColumn("c", F.col("m") - reduce(lambda a, r: a + F.col("d")[r], range(edits), F.lit(0))).filter("c > 0")
    rows = rows.withColumn("b", F.greatest(F.ceil(F.sqrt("c")).cast("int"), F.lit(edits)))
    # i: the block left out last; at0: where the line goes on after it; s: the shift there
    rows = rows.select("*", F.xxhash64("c").alias("g"), F.lit(-1).alias("i"), F.lit(0).alias("at0"), F.lit(0).alias("s"), F.lit("").alias("mid"))
    edge = lambda i: F.floor(i * F.col("c").cast("long") / F.col("b")).cast("int")
    for r in range(edits):
        more = F.col("d")[r]
        rows = rows.withColumn("i", F.explode(F.sequence(F.col("i") + 1, F.col("b") - (edits - r))))
        rows = rows.withColumn("x", edge(F.col("i")) + F.col("s")).withColumn("y", edge(F.col("i") + 1) + F.col("s") + more).filter("y >= x")
        rows = rows.select("h", "at", "line", "c", "b", "d", "i", F.col("y").alias("at0"), (F.col("s") + more).alias("s"),
                           F.xxhash64("g", "i", F.substr("line", F.col("at0") + 1, F.col("x") - F.col("at0"))).alias("g"),
                           F.concat("mid", F.lit(BREAK), F.substr("line", F.col("x") + 1, F.col("y") - F.col("x"))).alias("mid"))
    return rows.select("h", "at", F.xxhash64("g", F.substr("line", F.col("at0") + 1)).alias("g"), "mid").distinct()


def _holes(blocks: DataFrame, edits: int) -> DataFrame:
    """Step 3 keys for more than one edit."""
    rows = blocks.withColumnRenamed("mid", "rest")
    for _ in range(edits):
        size = F.char_length("rest")
        chars = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
        hole = lambda i, n: F.struct(F.xxhash64("g", F.left("rest", i - 1)).alias("g"), F.substr("rest", i + n).alias("rest"))
        gaps = F.transform(F.sequence(F.lit(1), size + 1), lambda i: hole(i, 0))  # noqa: B023
        taken = F.transform(F.filter(chars, lambda i: F.substr("rest", i, F.lit(1)) != BREAK), lambda i: hole(i, 1))  # noqa: B023
        rows = rows.select("h", "at", F.inline(F.array_distinct(F.concat(gaps, taken))))
    return rows.select("h", "at", F.xxhash64("g", "rest").alias("key"))


def dropped_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                  min_chars: int | None = None) -> DataFrame:
    """``(__id, __th, dropped)``: ascending line numbers (from 0) to drop, for documents that lose any."""
    if edits < 1:
        raise ValueError("edits must be at least 1")
    docs = common.keyed(df, id_col, text_col)
    lines = common.materialize(
        _lines(docs.filter("__text is not null"), edits, MIN_CHARS if min_chars is None else min_chars), "lines")
    unique = common.materialize(lines.groupBy("h", "m").agg(
        F.min("at").alias("at"), F.count("*").alias("copies"), F.first("halves").alias("halves")), "unique-lines")
    company = _shared(unique.select("h", "m", "at", F.explode("halves").alias("key")), "key").select("h", "m", "at").distinct()
    # texts of the lines with company, read where they first stand
    want = company.groupBy(F.col("at.id").alias("_id"), F.col("at.th").alias("_th")).agg(
        F.collect_list(F.struct("h", "m", "at")).alias("want"))
    once = docs.join(want, F.col("_id").eqNullSafe(F.col("__id")) & (F.col("_th") == F.col("__th")))
    texts = common.materialize(
        once.select(F.split("__text", BREAK).alias("all"), F.inline("want"))
        .select("h", "m", "at", F.element_at("all", F.col("at.n") + 1).alias("line")).dropDuplicates(["h", "m"]), "line-texts")
    parts = _characters(_shared(_blocks(texts), "g")) if edits == 1 else _holes(_shared(_block_sets(texts, edits), "g"), edits)
    keys = common.materialize(parts, "line-variants")
    first = keys.groupBy("key").agg(F.min(F.struct("at", "h")).alias("e"), F.count("*").alias("k")).filter("k > 1") \
        .select(F.col("key").alias("_key"), "e")
    near = (keys.join(first, F.col("key") == F.col("_key")).filter("e.at < at")
            .groupBy("h", "at").agg(F.min("e").alias("e")))
    mine = texts.select(F.col("h").alias("_h1"), F.col("at").alias("_a1"), F.col("line").alias("l1"))
    other = texts.select(F.col("h").alias("_h2"), F.col("at").alias("_a2"), F.col("line").alias("l2"))
    distance = F.levenshtein("l1", "l2", edits)  # -1 beyond the bound
    near = (near.join(mine, (F.col("h") == F.col("_h1")) & (F.col("at") == F.col("_a1")))
            .join(other, (F.col("e.h") == F.col("_h2")) & (F.col("e.at") == F.col("_a2")))
            .filter((distance >= 0) & (distance <= edits)).select(F.col("h").alias("_nh"), F.col("at").alias("_na")))
    judged = (unique.join(near, (F.col("h") == F.col("_nh")) & (F.col("at") == F.col("_na")), "left")
              .filter("copies > 1 or _nh is not null")
              .select(F.col("h").alias("_h"), F.col("m").alias("_m"), F.col("at").alias("_at"), F.col("_nh").isNotNull().alias("_near")))
    gone = lines.join(judged, (F.col("h") == F.col("_h")) & (F.col("m") == F.col("_m"))).filter("_near or at > _at")
    return gone.groupBy(F.col("at.id").alias("__id"), F.col("at.th").alias("__th")).agg(
        F.sort_array(F.collect_set("at.n")).alias("dropped"))


def deduplicate_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                      min_chars: int | None = None) -> DataFrame:
    """``df`` with the text rebuilt from the lines that stay, and ``dropped`` (line numbers)."""
    found = dropped_lines(df, id_col=id_col, text_col=text_col, edits=edits, min_chars=min_chars)
    out = common.join_flags(df.drop("dropped"), found, id_col, text_col, "left")
    none = F.array().cast("array<int>")
    out = out.withColumn("dropped", F.coalesce("dropped", none))
    kept = F.filter(F.split(F.col(text_col), BREAK), lambda x, i: ~F.array_contains("dropped", i))
    return out.withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.array_join(kept, BREAK)))


def line_report(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                min_chars: int | None = None) -> DataFrame:
    """``id, n_lines, n_dropped, dropped`` of every row."""
    found = dropped_lines(df, id_col=id_col, text_col=text_col, edits=edits, min_chars=min_chars)
    rows = common.keyed(df, id_col, text_col).select(
        "__id", "__th", F.coalesce(F.size(F.split("__text", BREAK)).cast("long"), F.lit(0).cast("long")).alias("n_lines"))
    rows = rows.select(F.col("__id").alias("_i"), F.col("__th").alias("_t"), F.greatest("n_lines", F.lit(0)).alias("n_lines"))
    out = rows.join(found, F.col("_i").eqNullSafe(F.col("__id")) & (F.col("_t") == F.col("__th")), "left")
    return out.select(F.col("_i").alias(id_col), "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))

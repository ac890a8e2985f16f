"""Oversized texts: one text over many tasks.

Skew in this data comes from the length of texts, not from keys: a text of 100 MB is one
row and so one task.  Here a text above a limit is cut into pieces at seams, the pieces
are dealt over the cluster, scanned by the same expressions as any text, and their findings
are put together again.

A seam is a place that no finding of the patterns can cross: after one of the ``CUT``
characters, which stand in no match, or between two words (letter, blank, letter), which
no pattern joins.  Pieces therefore need no overlap for patterns.  A dictionary phrase may
span a seam, so every piece also carries the first tokens of what follows (``ahead``), as many
as the longest phrase has less one; phrases that begin there belong to the next piece.

A stretch without any seam (one endless run, or an endless chain of numbers) stays in one
piece: it may be a single finding.  The scan of a piece is linear.

Rows are told apart by their key columns (null is a value) and a hash of the text; rows that
repeat both get equal findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions import patterns as P
from shroud.functions import spans as S
from shroud.functions.spans import FINDING_DDL, FINDINGS_DDL, empty, lit, ref
from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import redact as R

#: Texts of more bytes are cut.
LIMIT_BYTES = 8 << 20
#: Characters of a piece, to which its way to the next seam is added.
PIECE_CHARS = 1 << 20
#: Characters that stand in no match of the default patterns and in no token.
CUT = r"\n\r\t,;!?"


def _pieces(text: str, chars: int, cut: str) -> str:
    # possessive and lazy loops keep no stack, however long the piece
    return f"regexp_extract_all({text}, {lit(rf'(?s).{{1,{chars}}}+.*?(?:(?<=[{cut}])|(?<=[A-Za-z] )(?=[A-Za-z])|\z)')}, 0)"


def _ahead(pieces: str, tokens: int) -> str:
    """Behind every piece: the stretch of the following ones that holds ``tokens`` tokens (or all that is left)."""
    token = K.TOKEN_RE
    other = token.replace("[", "[^", 1).rstrip("+")
    first = lit(rf"^(?:{other}*+{token}+){{{tokens}}}+")
    acc, c, z = S._v("acc"), S._v("c"), S._v("z")
    step = S.let(f"regexp_extract({c}, {first}, 0)", lambda p: (
        f"named_struct('ahead', CASE WHEN {p} <> '' THEN {p} ELSE concat({c}, {acc}.ahead) END, 'out', concat(array({acc}.ahead), {acc}.out))"))
    return f"aggregate(reverse({pieces}), named_struct('ahead', '', 'out', CAST(array() AS array<string>)), ({acc}, {c}) -> {step}, {z} -> {z}.out)"


def cut(df: DataFrame, key_cols, text_col: str, *, piece_chars: int = PIECE_CHARS, cut_chars: str = CUT, ahead: int = 0) -> DataFrame:
    """``(__k0.., __th, part, at, piece, ahead)``: the pieces of every distinct key and text, dealt over all tasks.
    ``at`` is the piece's place in the text."""
    names = [f"__k{i}" for i in range(len(key_cols))]
    rows = df.select(*[F.col(ref(c)).alias(k) for c, k in zip(key_cols, names)], F.xxhash64(ref(text_col)).alias("__th"), F.col(ref(text_col)).alias("__text"))
    x, i = S._v("x"), S._v("i")

    def placed(ps):
        lens = f"transform({ps}, {x} -> named_struct('g', 0, 'm', length({x})))"
        follows = _ahead(ps, ahead) if ahead else "CAST(array() AS array<string>)"
        return S.let(S.let(lens, S._running), lambda at: S.let(follows, lambda fs: (
            f"transform({ps}, ({x}, {i}) -> named_struct('part', {i}, 'at', get({at}, {i}).start, 'piece', {x}, "
            f"'ahead', coalesce(get({fs}, {i}), '')))")))

    pieces = S.let(_pieces("__text", piece_chars, cut_chars), lambda ps: f"CASE WHEN size({ps}) > 0 THEN {placed(ps)} END")
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    out = rows.select(*names, "__th", F.inline_outer(F.expr(pieces))).where(F.col("part").isNotNull())
    return out.repartition(tasks, *names, "__th", "part")


def _together(df: DataFrame, key_cols, text_col: str, per_text: DataFrame) -> DataFrame:
    """``df`` with the columns of ``per_text`` (at most one row per key and text)."""
    left = df.withColumn("__rowhash", F.xxhash64(ref(text_col)))
    same = F.col("__rowhash") == F.col("__th")
    for i, c in enumerate(key_cols):
        same = same & left[ref(c)].eqNullSafe(per_text[f"__k{i}"])
    return left.join(per_text, same, "left").drop("__rowhash", "__th", *[f"__k{i}" for i in range(len(key_cols))])


def detect_in_pieces(df: DataFrame, key_cols, text_col: str = "text", patterns=P.DEFAULT, dictionary: DataFrame | None = None,
                     out: str = "findings", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """D1 (and D2, with a dictionary) of every text, scanned in pieces.  The same findings as the unsplit scan."""
    names = [f"__k{i}" for i in range(len(key_cols))]
    tokens = 0
    if dictionary is not None:
        tokens = (K.normalise(dictionary).agg(F.max("n")).first()[0] or 1) - 1
    pieces = cut(df, key_cols, text_col, piece_chars=piece_chars, ahead=tokens)
    found = D.detect_patterns(pieces, "piece", patterns, out="__f")
    if dictionary is not None:
        found = found.withColumn("__ahead", F.concat("piece", "ahead"))
        found = K.detect_keywords(found, "__ahead", dictionary, out="__kw", key_cols=[*names, "__th", "part"])
        x = S._v("x")
        own = f"filter(__kw, {x} -> {x}.start < length(piece))"  # the others begin in a later piece
        found = found.withColumn("__f", F.expr(f"concat(__f, {own})"))
    moved = F.transform("__f", lambda f: F.struct((f["start"] + F.col("at")).alias("start"), (f["end"] + F.col("at")).alias("end"),
                                                  f["entity"], f["detector"], f["score"]).cast(FINDING_DDL))
    # a repeated row has repeated pieces; the set holds a part once.  (A filter on the size here would be pushed
    # below the projection together with the whole detection, which would run twice.)
    per_text = found.select(*names, "__th", "part", moved.alias("__f")).groupBy(*names, "__th").agg(
        F.collect_set(F.struct("part", "__f")).alias("__parts")).select(
        *names, "__th", F.array_sort(F.flatten(F.transform("__parts", lambda p: p["__f"]))).alias("__found"))
    joined = _together(df, key_cols, text_col, per_text)
    keep = [F.col(ref(c)) for c in df.columns if c != out]
    prev = f"coalesce({ref(out)}, {empty(FINDING_DDL)})" if out in df.columns else empty(FINDING_DDL)
    return joined.select(*keep, F.expr(f"concat({prev}, coalesce(__found, {empty(FINDING_DDL)}))").alias(out))


def redact_in_pieces(df: DataFrame, key_cols, text_col: str = "text", spans_col: str = "findings", style: str = "label",
                     out: str = "redacted_text", piece_chars: int = PIECE_CHARS, merged: bool = False) -> DataFrame:
    """R4 piece by piece.  A span over a seam is replaced where it begins; its rest leaves the next piece."""
    if style not in R.STYLES:
        raise ValueError(f"style must be one of {R.STYLES}")
    df = df if merged else D.merge(df, spans_col)
    names = [f"__k{i}" for i in range(len(key_cols))]
    pieces = cut(df, key_cols, text_col, piece_chars=piece_chars)
    spans = df.select(*[F.col(ref(c)).alias(f"__s{i}") for i, c in enumerate(key_cols)], F.xxhash64(ref(text_col)).alias("__sth"),
                      F.col(ref(spans_col)).alias("__spans")).where(F.size("__spans") > 0)
    spans = spans.groupBy(*[f"__s{i}" for i in range(len(key_cols))], "__sth").agg(F.min("__spans").alias("__spans"))
    same = F.col("__th") == F.col("__sth")
    for i in range(len(key_cols)):
        same = same & F.col(f"__k{i}").eqNullSafe(F.col(f"__s{i}"))
    met = pieces.join(spans, same, "left")
    x, y = S._v("x"), S._v("y")
    end = "at + length(piece)"
    met = met.select(*names, "__th", "part", "at", "piece",
                     F.expr(f"coalesce(__spans, {empty(FINDING_DDL)})").alias("__spans"))
    met = met.withColumn("__over", F.expr(f"greatest(0, coalesce(array_max(transform(filter(__spans, {x} -> {x}.start < at), {y} -> least({y}.end, {end}))), 0) - at)"))
    inside = (f"transform(filter(__spans, {x} -> {x}.start >= at AND {x}.start < {end}), {y} -> named_struct('start', {y}.start - at - __over, "
              f"'end', least({y}.end, {end}) - at - __over, 'entity', {y}.entity, 'detector', {y}.detector, 'score', {y}.score))")
    rest = "substring(piece, __over + 1, 2147483647)"
    carried = "repeat('*', __over)" if style == "mask" else "''"
    # a label stands where its span begins; cut masks add up to the span's length
    text = f"concat({carried}, {S.redact_text(rest, f'CAST({inside} AS {FINDINGS_DDL})', lit(style))})"
    done = met.select(*names, "__th", "part", F.expr(text).alias("__piece"))
    per_text = done.groupBy(*names, "__th").agg(F.array_sort(F.collect_set(F.struct("part", "__piece"))).alias("__p")).select(
        *names, "__th", F.array_join(F.transform("__p", lambda p: p["__piece"]), "").alias("__redacted"))
    joined = _together(df, key_cols, text_col, per_text)
    keep = [F.col(ref(c)) for c in df.columns if c != out]
    # a text without pieces is empty (or null) and stays as it is
    return joined.select(*keep, F.coalesce("__redacted", ref(text_col)).alias(out))


def by_size(df: DataFrame, text_col: str, small, large, *, limit: int = LIMIT_BYTES, size: Column | None = None) -> DataFrame:
    """``small(rows)`` for the ordinary texts and ``large(rows)`` for those of more than ``limit`` bytes, as one table.

    ``size``: a stored length, with which the second scan reads only files and row groups that hold
    large texts (the filter reaches Parquet)."""
    n = size if size is not None else F.octet_length(ref(text_col))
    is_large = F.coalesce(n > limit, F.lit(False))
    return small(df.where(~is_large)).unionByName(large(df.where(n > limit)))


def detect(df: DataFrame, key_cols, text_col: str = "text", patterns=P.DEFAULT, dictionary: DataFrame | None = None, *,
           limit: int = LIMIT_BYTES, piece_chars: int = PIECE_CHARS, size: Column | None = None) -> DataFrame:
    """D1 and D2 for texts of any size."""
    def small(rows):
        found = D.detect_patterns(rows, text_col, patterns)
        return found if dictionary is None else K.detect_keywords(found, text_col, dictionary, key_cols=key_cols)
    return by_size(df, text_col, small, lambda rows: detect_in_pieces(rows, key_cols, text_col, patterns, dictionary, piece_chars=piece_chars),
                   limit=limit, size=size)


def redact(df: DataFrame, key_cols, text_col: str = "text", spans_col: str = "findings", style: str = "label", *, out: str = "redacted_text",
           limit: int = LIMIT_BYTES, piece_chars: int = PIECE_CHARS, size: Column | None = None) -> DataFrame:
    """R4 for texts of any size; ``spans_col`` holds merged findings."""
    return by_size(df, text_col, lambda rows: R.apply_redactions(rows, text_col, spans_col, style, out=out, merged=True),
                   lambda rows: redact_in_pieces(rows, key_cols, text_col, spans_col, style, out=out, piece_chars=piece_chars, merged=True),
                   limit=limit, size=size)

"""Dictionary words and phrases, case-insensitive, whole word.

A text is cut into tokens (maximal runs of letters, marks and digits) with
code-point offsets on the array plane.  A phrase matches where its lowered
token sequence equals the text's lowered tokens at consecutive positions, so
matching is whole-word by construction and blind to punctuation and spacing
between the words.

A phrase is looked up by the hash of its first n-gram (its first ``GRAM`` tokens, or all
of a shorter phrase), so phrases that share a first word cost no more than others.  Every
hit is verified against the whole phrase on the text itself, and offsets are computed only
for texts with a hit.  Both plans test the same lowered tokens and give the same rows:

* a dictionary of up to ``LITERAL_BYTES`` travels in the expression: a hash-set test per
  token position on the row; no join, no shuffle;
* a larger one is joined on the hash, broadcast only up to ``BROADCAST_BYTES``.  Its hits come
  back to the rows by the key columns (nulls are equal) and the hash of the text, once per
  distinct key and text, so rows without a key or with another's key get their own findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions import spans as S
from shroud.functions.spans import FINDING_DDL, empty, lit, ref, regex_matches

TOKEN_RE = r"[\p{L}\p{M}\p{N}]+"
GRAM = 4                      # tokens of the n-gram a phrase is looked up by
LITERAL_BYTES = 256 << 10     # dictionary text inside the expression; above this the join plan
BROADCAST_BYTES = 16 << 20    # dictionary text that is broadcast; above this a shuffle join
DICT_SCHEMA = "entity string, phrase string"

# ---- fixed values: built-in keyword list (entity, phrase) ----
KEYWORDS = (
    ("secret_keyword", "password"),
    ("secret_keyword", "secret"),
    ("secret_keyword", "token"),
    ("secret_keyword", "confidential"),
    ("secret_keyword", "api key"),
    ("license", "MIT License"),
    ("license", "Apache License"),
    ("license", "GNU General Public License"),
)
# ---- end of fixed values ----


_NORMALISED: dict[tuple, list] = {}  # literal dictionaries: rows -> normalised rows (Spark-computed once)


def keyword_dictionary(spark: SparkSession, rows=KEYWORDS) -> DataFrame:
    df = spark.createDataFrame(list(rows), DICT_SCHEMA)
    df._shroud_rows = tuple(rows)  # an in-memory dictionary: its normalised form can be reused
    return df


def passage_dictionary(benchmark: DataFrame, entity: str = "benchmark") -> DataFrame:
    return benchmark.select(F.lit(entity).alias("entity"), F.col("text").alias("phrase"))


def _gram_key(tokens: str, start: str, g: str) -> str:
    """Hash of ``g`` tokens from the 1-based ``start``."""
    return f"xxhash64({g}, array_join(slice({tokens}, {start}, {g}), ' '))"


def normalise(dictionary: DataFrame) -> DataFrame:
    """entity, n, phrase (lowered tokens joined by one blank), g and key (first n-gram), first (hash of the first token)."""
    toks = F.transform(regex_matches(F.col("phrase"), TOKEN_RE), lambda t: F.lower(t))
    d = dictionary.select("entity", toks.alias("toks")).where(F.size("toks") > 0)
    d = d.withColumn("n", F.size("toks")).withColumn("g", F.least("n", F.lit(GRAM)))
    return d.select("entity", "n", F.array_join("toks", " ").alias("phrase"), "g",
                    F.expr(_gram_key("toks", "1", "g")).alias("key"),
                    F.xxhash64(F.get("toks", F.lit(0))).alias("first")).distinct()


def _text_bytes(norm: DataFrame) -> int:
    return norm.agg(F.sum(F.octet_length("phrase") + F.octet_length("entity"))).first()[0] or 0


def _lowered(text: str) -> str:
    t = S._v("t")
    return f"transform(regexp_extract_all({text}, {lit(TOKEN_RE)}, 0), {t} -> lower({t}))"


def _spans(text: str) -> str:
    return S.find_all(text, f"regexp_extract_all({text}, {lit(TOKEN_RE)}, 0)", TOKEN_RE)


def _literal_findings(text: str, rows) -> str:
    """The findings of one text as one expression.  Long ``IN`` lists become hash sets,
    so a token position costs the same whatever the number of phrases."""
    by_key: dict[int, list] = {}
    for entity, n, phrase, _g, key, _first in rows:
        by_key.setdefault(key, []).append((n, phrase, entity))
    cand_t = "array<struct<n:int,phrase:string,entity:string>>"
    def entry(key):
        cands = ", ".join(f"named_struct('n', {n}, 'phrase', {lit(p)}, 'entity', {lit(e)})" for n, p, e in sorted(by_key[key]))
        return f"CAST('{key}' AS BIGINT), CAST(array({cands}) AS {cand_t})"

    pairs = ", ".join(entry(key) for key in sorted(by_key))
    firsts = ", ".join(f"CAST('{x}' AS BIGINT)" for x in sorted({r[5] for r in rows}))
    grams = {g: ", ".join(f"CAST('{x}' AS BIGINT)" for x in sorted({r[4] for r in rows if r[3] == g})) for g in sorted({r[3] for r in rows})}

    def body(lt):
        i, j, c, h = S._v("i"), S._v("j"), S._v("c"), S._v("h")
        key = {g: _gram_key(lt, f"{i} + 1", str(g)) for g in grams}
        test = " OR ".join(f"{key[g]} IN ({grams[g]})" for g in grams)
        hits = f"filter(sequence(0, size({lt}) - 1), {i} -> xxhash64(get({lt}, {i})) IN ({firsts}) AND ({test}))"
        found = ", ".join(f"coalesce(try_element_at(map({pairs}), {_gram_key(lt, f'{j} + 1', str(g))}), CAST(array() AS {cand_t}))" for g in grams)

        def spans(sp, at):
            ok = (f"filter(flatten(array({found})), {c} -> {j} + {c}.n <= size({lt}) "
                  f"AND array_join(slice({lt}, {j} + 1, {c}.n), ' ') = {c}.phrase)")
            one = (f"transform({ok}, {h} -> named_struct('start', get({sp}, {j}).start, 'end', get({sp}, {j} + {h}.n - 1).end, "
                   f"'entity', {h}.entity, 'detector', 'keyword', 'score', CAST(1.0 AS DOUBLE)))")
            return f"flatten(transform({at}, {j} -> {one}))"

        placed = S.let(hits, lambda at: f"CASE WHEN size({at}) = 0 THEN {empty(FINDING_DDL)} "
                                        f"ELSE {S.let(_spans(text), lambda sp: spans(sp, at))} END")
        return f"CASE WHEN coalesce(size({lt}), 0) <= 0 THEN {empty(FINDING_DDL)} ELSE {placed} END"

    return S.let(_lowered(text), body) if rows else empty(FINDING_DDL)


def detect_keywords(df: DataFrame, text_col: str, dictionary: DataFrame, out: str = "findings",
                    key_cols=None, path: str = "auto", enabled: Column | None = None) -> DataFrame:
    """D2 on the array plane: appends keyword findings to ``out``.

    ``path``: ``literal``, ``join`` or ``auto`` (literal up to ``LITERAL_BYTES`` of
    dictionary text).  The join plan needs ``key_cols`` to bring the findings back; they
    may be null or repeated.
    """
    norm = normalise(dictionary)
    rows = None
    known = getattr(dictionary, "_shroud_rows", None)
    if path != "join":
        rows = _NORMALISED.get(known) if known is not None else None
        if rows is None and _text_bytes(norm) <= LITERAL_BYTES:
            rows = [tuple(r) for r in norm.select("entity", "n", "phrase", "g", "key", "first").collect()]
            if known is not None:
                _NORMALISED[known] = rows
        if rows is None and path == "literal":
            raise ValueError(f"dictionary larger than {LITERAL_BYTES} bytes; use the join plan")
    keep = [F.col(ref(c)) for c in df.columns if c != out]
    prev = f"coalesce({ref(out)}, {empty(FINDING_DDL)})" if out in df.columns else empty(FINDING_DDL)
    src = df if enabled is None else df.withColumn("__kwtext", F.when(enabled, F.col(text_col)))
    text = text_col if enabled is None else "__kwtext"
    if rows is not None:
        return src.select(*keep, F.expr(f"concat({prev}, {_literal_findings(ref(text), rows)})").alias(out))
    if not key_cols:
        raise ValueError("the join plan needs key_cols")
    joined = _with_candidates(src, key_cols, text, norm)
    return joined.select(*keep, F.expr(f"concat({prev}, {_verified(ref(text), '__c')})").alias(out))


def _grams(text: str, lens) -> str:
    """``array<struct<pos,key>>``: the n-grams of a text that could begin a phrase."""
    i, g = S._v("i"), S._v("g")
    sizes = f"array({', '.join(map(str, lens)) or 'CAST(NULL AS INT)'})"
    return S.let(_lowered(text), lambda lt: (
        f"CASE WHEN coalesce(size({lt}), 0) <= 0 THEN CAST(array() AS array<struct<pos:int,key:bigint>>) ELSE "
        f"flatten(transform(sequence(0, size({lt}) - 1), {i} -> transform(filter({sizes}, "
        f"{g} -> {i} + {g} <= size({lt})), {g} -> named_struct('pos', {i}, 'key', {_gram_key(lt, f'{i} + 1', g)})))) END"))


def _with_candidates(df: DataFrame, key_cols, text_col: str, norm: DataFrame) -> DataFrame:
    """``df`` with ``__c``: the phrases whose first n-gram stands in the text, with its position (null: none).

    Narrow rows (key, text hash, position, n-gram hash) meet the dictionary.  Repeated rows
    make equal candidates, which the set of a key and text holds once."""
    lens = sorted(r["g"] for r in norm.select("g").distinct().collect())  # at most GRAM rows
    names = {c: f"__k{i}" for i, c in enumerate(key_cols)}
    hashed = F.xxhash64(F.col(ref(text_col)))
    narrow = df.select(*[F.col(ref(c)).alias(k) for c, k in names.items()], hashed.alias("__th"), F.col(ref(text_col)).alias("__text"))
    # outer + filter: no inferred size() filter pushed into the scan (see explode_findings)
    bare = narrow.select(*names.values(), "__th", F.inline_outer(F.expr(_grams("__text", lens)))).where(F.col("pos").isNotNull())
    d = norm.select(F.col("key").alias("__key"), "n", "phrase", "entity")
    if _text_bytes(norm) <= BROADCAST_BYTES:
        d = F.broadcast(d)
    cand = bare.join(d, F.col("key") == F.col("__key")).groupBy(*names.values(), "__th").agg(
        F.collect_set(F.struct("pos", "n", "phrase", "entity")).alias("__c"))
    left = df.withColumn("__rowhash", hashed)
    same = F.col("__rowhash") == F.col("__th")
    for c, k in names.items():
        same = same & left[ref(c)].eqNullSafe(cand[k])
    return left.join(cand, same, "left").drop("__rowhash", "__th", *names.values())


def _verified(text: str, candidates: str) -> str:
    """The findings among the candidates of one text."""
    c, h = S._v("c"), S._v("h")
    ok = S.let(_lowered(text), lambda lt: (
        f"filter({candidates}, {c} -> array_join(slice({lt}, {c}.pos + 1, {c}.n), ' ') = {c}.phrase AND {c}.pos + {c}.n <= size({lt}))"))
    placed = S.let(ok, lambda hits: f"CASE WHEN size({hits}) = 0 THEN {empty(FINDING_DDL)} ELSE " + S.let(
        _spans(text), lambda sp: (f"transform({hits}, {h} -> named_struct('start', get({sp}, {h}.pos).start, 'end', get({sp}, {h}.pos + {h}.n - 1).end, "
                                  f"'entity', {h}.entity, 'detector', 'keyword', 'score', CAST(1.0 AS DOUBLE)))")) + " END")
    return f"CASE WHEN {candidates} IS NULL THEN {empty(FINDING_DDL)} ELSE {placed} END"


def keyword_table(df: DataFrame, key_cols, text_col: str, dictionary: DataFrame,
                  normalised: DataFrame | None = None) -> DataFrame:
    """D2, table plane: key..., start, end_, entity, detector (join plan)."""
    norm = normalised if normalised is not None else normalise(dictionary)
    found = _with_candidates(df, key_cols, text_col, norm).select(*key_cols, F.expr(_verified(ref(text_col), "__c")).alias("__f"))
    return found.select(*key_cols, F.inline_outer("__f")).where(F.col("start").isNotNull()) \
        .select(*key_cols, "start", F.col("end").alias("end_"), "entity", "detector")


__all__ = ["KEYWORDS", "TOKEN_RE", "detect_keywords", "keyword_table", "keyword_dictionary",
           "passage_dictionary", "normalise"]

"""Span arithmetic on the array plane: find-all with offsets, merge, redact.

Every builder returns Spark SQL expression *text* made of built-ins (regex,
array and higher-order functions); ``col`` turns it into one Column with a
single ``F.expr`` call, so building a plan costs one parse in the JVM instead
of thousands of Python-to-JVM calls.  Nothing here shuffles or calls Python
per row.

Offsets are 0-based, end exclusive, counted in Unicode code points, which is
what Spark's ``length``/``substring`` (and Python, and DuckDB) count.

Inputs are SQL snippets: a column reference (``ref("text")``) or any
expression.  Inputs used more than once are bound to a lambda variable
(``let``), so they are evaluated once per row even where Catalyst folds the
projection that produced them into this one.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH_DDL = "struct<start:int,end:int>"
FINDING_DDL = "struct<start:int,end:int,entity:string,detector:string,score:double>"
FINDINGS_DDL = f"array<{FINDING_DDL}>"
DECISION_DDL = "struct<start:int,end:int,action:string,entity:string>"

# Up to this many spans, redaction cuts gaps with ``substring`` (each call scans
# from the start of the text); above it a code-point array gives O(1) cuts.
SMALL_SPANS = 256

# ---- fixed values: detector priority for the label of a merged span ----
DETECTOR_RANK = {"review": 0, "pattern": 1, "keyword": 2, "ner": 3}
# ---- end of fixed values ----

_ids = itertools.count()


def _v(prefix: str = "v") -> str:
    return f"__{prefix}{next(_ids)}"


def ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lit(s: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(sql: str) -> Column:
    return F.expr(sql)


def let(value: str, body) -> str:
    """Evaluate ``value`` once and pass its lambda variable to ``body``."""
    v = _v()
    return f"get(transform(array({value}), {v} -> {body(v)}), 0)"


def empty(ddl: str) -> str:
    return f"CAST(array() AS array<{ddl}>)"


# ---- D1: find-all with offsets ----
def _running(lens: str) -> str:
    """Start and end of every match, from the lengths ``g`` of the text before it and ``m`` of itself.

    Appending to an array copies it, so the running sum goes over stretches of about the square root of
    the number of matches, and then over the stretches' totals."""
    i, k, acc, x, a2, t, s, b, y, z = (_v(n) for n in ("i", "k", "acc", "x", "acc", "t", "s", "b", "y", "z"))
    end = f"{acc}.pos + {x}.g + {x}.m"
    stretch = (f"aggregate({s}, named_struct('pos', 0, 'out', {empty(MATCH_DDL)}), ({acc}, {x}) -> named_struct('pos', {end}, 'out', "
               f"concat({acc}.out, array(named_struct('start', {acc}.pos + {x}.g, 'end', {end})))))")

    def cut(size):
        slices = f"transform(sequence(0, CAST((size({lens}) - 1) DIV {size} AS INT)), {i} -> slice({lens}, {i} * {size} + 1, {size}))"
        return let(f"transform({slices}, {s} -> {stretch})", whole)

    def whole(parts):
        bases = (f"aggregate({parts}, named_struct('pos', 0, 'out', CAST(array() AS array<int>)), ({a2}, {t}) -> "
                 f"named_struct('pos', {a2}.pos + {t}.pos, 'out', concat({a2}.out, array({a2}.pos))), {k} -> {k}.out)")
        return (f"flatten(zip_with({parts}, {bases}, ({y}, {b}) -> transform({y}.out, {z} -> "
                f"named_struct('start', {z}.start + {b}, 'end', {z}.end + {b}))))")

    return let(f"CAST(ceil(sqrt(size({lens}))) AS INT)", cut)


def regex_matches(text: Column, regex: str) -> Column:
    """All non-overlapping matches, left to right (texts only)."""
    return F.regexp_extract_all(text, F.lit(regex), F.lit(0))


def find_all(text: str, m: str, regex: str, check: str | None = None) -> str:
    """``array<struct<start,end>>`` for the matches ``m`` of ``regex`` in ``text``.

    ``m`` is ``regex_matches(text, regex)`` materialised in its own projection
    (the regex runs once more, to split).  Null or matchless text gives ``[]``.
    ``check`` (see ``CHECKS``) drops the matches that fail it.
    """
    a, b, x, i = _v("a"), _v("b"), _v("x"), _v("i")

    def body(v):
        t, mm = f"{v}.t", f"{v}.m"
        lens = (f"zip_with({mm}, slice(split({t}, {lit(regex)}, -1), 1, size({mm})), "
                f"({a}, {b}) -> named_struct('g', length({b}), 'm', length({a})))")
        found = let(lens, _running)
        if check:
            found = f"filter({found}, ({x}, {i}) -> {CHECKS[check](f'get({mm}, {i})')})"
        return f"CASE WHEN {t} IS NULL OR {mm} IS NULL OR size({mm}) = 0 THEN {empty(MATCH_DDL)} ELSE {found} END"
    return let(f"named_struct('t', {text}, 'm', {m})", body)


def luhn(match: str) -> str:
    """13 to 19 digits whose check digit is right."""
    i, acc = _v("i"), _v("acc")
    digit = lambda d: f"CAST(substring({d}, -{i}, 1) AS INT)"
    total = lambda d: (f"aggregate(sequence(1, length({d})), 0, ({acc}, {i}) -> {acc} + CASE WHEN {i} % 2 = 1 THEN {digit(d)} "  # noqa: E731
                       f"WHEN {digit(d)} > 4 THEN 2 * {digit(d)} - 9 ELSE 2 * {digit(d)} END)")
    return let(f"regexp_replace({match}, '[ -]', '')", lambda d: f"CASE WHEN length({d}) BETWEEN 13 AND 19 THEN {total(d)} % 10 = 0 ELSE false END")


def octets(match: str) -> str:
    """Four numbers of at most 255."""
    x = _v("x")
    return let(f"split({match}, '[.]')", lambda p: f"size({p}) = 4 AND forall({p}, {x} -> length({x}) <= 3 AND CAST({x} AS INT) <= 255)")


CHECKS = {"luhn": luhn, "octets": octets}


def to_findings(matches: str, entity: str, detector: str = "pattern", score: float = 1.0) -> str:
    x = _v("x")
    return (f"transform({matches}, {x} -> named_struct('start', {x}.start, 'end', {x}.end, "
            f"'entity', {lit(entity)}, 'detector', {lit(detector)}, 'score', CAST({float(score)!r} AS DOUBLE)))")


# ---- D7: merge ----
def detector_rank(detector: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in DETECTOR_RANK.items())
    return f"CASE {detector} {whens} ELSE {len(DETECTOR_RANK)} END"


def _islands(s: str, body) -> str:
    """``body(members, end)`` for every island of connected overlaps of the spans ``s``
    (sorted by start); ``members`` is the island's slice, ``end`` its largest end.

    Linear after two sorts: span i starts an island iff all i spans before it have
    ended, that is, iff the i-th smallest end is at most its start."""
    i, k, h, x = _v("i"), _v("k"), _v("h"), _v("x")

    def over(ends):
        heads = (f"filter(sequence(0, size({s}) - 1), {i} -> {i} = 0 OR get({ends}, {i} - 1) <= get({s}, {i}).start)")
        return let(heads, lambda hs: let(
            f"transform({hs}, ({h}, {k}) -> coalesce(get({hs}, {k} + 1), size({s})))",
            lambda stops: f"transform({hs}, ({h}, {k}) -> "
            + let(f"slice({s}, {h} + 1, get({stops}, {k}) - {h})", lambda m: body(m, f"get({ends}, get({stops}, {k}) - 1)")) + ")"))

    return let(f"array_sort(transform({s}, {x} -> {x}.end))", over)


def merge_spans(findings: str) -> str:
    """One span per connected overlap (touching spans stay apart).

    The label comes from the member with the best (detector rank, longest span,
    earliest start, smallest entity name); the score is the island's maximum.
    Sorted by start; one algorithm, linear after sorting.
    """
    x, y = _v("x"), _v("y")

    def one(members, end):
        best = (f"array_min(transform({members}, {x} -> named_struct('r', {detector_rank(f'{x}.detector')}, 'l', {x}.start - {x}.end, "
                f"'s', {x}.start, 'e', {x}.entity, 'd', {x}.detector)))")
        return let(best, lambda b: (
            f"named_struct('start', get({members}, 0).start, 'end', {end}, 'entity', {b}.e, 'detector', {b}.d, "
            f"'score', array_max(transform({members}, {y} -> {y}.score)))"))

    return let(f"sort_array(coalesce({findings}, {empty(FINDING_DDL)}))",
               lambda s: f"CASE WHEN size({s}) = 0 THEN {empty(FINDING_DDL)} ELSE {_islands(s, one)} END")


# ---- R4: redact ----
def replacement(span: str, style: str) -> str:
    return (f"CASE {style} WHEN 'label' THEN concat('[', upper({span}.entity), ']') "
            f"WHEN 'mask' THEN repeat('*', {span}.end - {span}.start) ELSE '' END")


def style_sql(style: str) -> str:
    """A style name (label / mask / drop) as a literal, anything else as a column."""
    return lit(style) if style in ("label", "mask", "drop") else ref(style)


def redact_text(text: str, spans: str, style: str = "'label'", small: int = SMALL_SPANS) -> str:
    """Replace every span of ``spans`` (sorted, disjoint) in ``text``."""
    def body(t, sp):
        x, i = _v("x"), _v("i")
        pe = f"(CASE WHEN {i} = 0 THEN 0 ELSE get({sp}, {i} - 1).end END)"
        last = f"coalesce(get({sp}, size({sp}) - 1).end, 0)"
        rep = replacement(x, style)
        by_substring = (f"concat(array_join(transform({sp}, ({x}, {i}) -> concat(substring({t}, {pe} + 1, "
                        f"{x}.start - {pe}), {rep})), ''), substring({t}, {last} + 1, 2147483647))")
        by_chars = let(f"split({t}, '')", lambda ch: (
            f"concat(array_join(transform({sp}, ({x}, {i}) -> concat(array_join(slice({ch}, {pe} + 1, "
            f"{x}.start - {pe}), ''), {rep})), ''), array_join(slice({ch}, {last} + 1, "
            f"greatest(size({ch}) - {last}, 0)), ''))"))
        return (f"CASE WHEN {t} IS NULL THEN CAST(NULL AS STRING) WHEN coalesce(size({sp}), 0) = 0 THEN {t} "
                f"WHEN size({sp}) <= {small} THEN {by_substring} ELSE {by_chars} END")
    return let(text, lambda t: let(spans, lambda sp: body(t, sp)))


# ---- D4: greedy decoding ----
def greedy_decode(findings: str) -> str:
    """Highest score first (then start, end, entity); a span is kept unless
    it overlaps one already kept.  Result sorted by start.  Spans only compete inside
    their island of overlaps, so the cost is linear but for the size of one island."""
    key_ddl = "struct<neg:double,start:int,end:int,entity:string,detector:string,score:double>"
    x, acc, y, k, z = _v("x"), _v("acc"), _v("y"), _v("k"), _v("z")

    def one(members, _end):
        keyed = (f"sort_array(transform({members}, {x} -> named_struct('neg', -{x}.score, 'start', {x}.start, "
                 f"'end', {x}.end, 'entity', {x}.entity, 'detector', {x}.detector, 'score', {x}.score)))")
        kept = (f"aggregate({keyed}, {empty(key_ddl)}, ({acc}, {y}) -> CASE WHEN exists({acc}, {k} -> "
                f"{k}.start < {y}.end AND {y}.start < {k}.end) THEN {acc} ELSE concat({acc}, array({y})) END)")
        return (f"CASE WHEN size({members}) = 1 THEN {members} ELSE transform({kept}, {z} -> named_struct('start', {z}.start, "
                f"'end', {z}.end, 'entity', {z}.entity, 'detector', {z}.detector, 'score', {z}.score)) END")

    return let(f"sort_array(coalesce({findings}, {empty(FINDING_DDL)}))", lambda s: (
        f"CASE WHEN size({s}) = 0 THEN {empty(FINDING_DDL)} ELSE sort_array(flatten({_islands(s, one)})) END"))


# ---- H2 on the array plane ----
def apply_decisions(findings: str, decisions: str) -> str:
    """Rejected spans leave, added spans join, the rest stay; merged again."""
    def body(fs, ds):
        x, y, z = _v("x"), _v("y"), _v("z")
        kept = (f"filter({fs}, {x} -> NOT exists({ds}, {y} -> {y}.action = 'reject' AND {y}.start = {x}.start "
                f"AND {y}.end = {x}.end))")
        adds = (f"transform(filter({ds}, {y} -> {y}.action = 'add'), {z} -> named_struct('start', {z}.start, "
                f"'end', {z}.end, 'entity', {z}.entity, 'detector', 'review', 'score', CAST(1.0 AS DOUBLE)))")
        return merge_spans(f"concat({kept}, {adds})")
    return let(f"coalesce({findings}, {empty(FINDING_DDL)})",
               lambda fs: let(f"coalesce({decisions}, {empty(DECISION_DDL)})", lambda ds: body(fs, ds)))

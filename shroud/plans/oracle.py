"""DuckDB SQL for the correctness oracle.

Each builder returns a SQL *subquery* (no trailing semicolon) over the
pre-registered views (documents, pages, conversations, benchmark, labels,
events).  The SQL follows a different route from the Spark code on purpose:
offsets by list sums over split pieces, merge by window islands, redaction by
``string_agg`` -- so an agreement means something.
"""

from __future__ import annotations

from shroud.functions import patterns as P
from shroud.functions.spans import DETECTOR_RANK


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pattern_findings(src: str, keys: str, text: str = "text", patterns=P.DEFAULT) -> str:
    """(keys..., start, end_, entity, detector, score) for every pattern match."""
    parts = []
    for p in patterns:
        r = q(p.regex)
        parts.append(
            f"SELECT {keys}, {q(p.entity)} AS entity, ms, ps FROM ("
            f"SELECT {keys}, regexp_extract_all({text}, {r}) AS ms, "
            f"string_split_regex({text}, {r}) AS ps FROM {src}) AS z WHERE len(ms) > 0")
    allm = " UNION ALL ".join(parts)
    return (
        f"SELECT {keys}, "
        f"CAST(length(array_to_string(ps[1:i], '')) + length(array_to_string(ms[1:i-1], '')) AS INTEGER) AS start, "
        f"CAST(length(array_to_string(ps[1:i], '')) + length(array_to_string(ms[1:i], '')) AS INTEGER) AS end_, "
        f"entity, 'pattern' AS detector, CAST(1.0 AS DOUBLE) AS score "
        f"FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM ({allm}) AS u) AS x")


def rank_case(col: str = "detector") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in DETECTOR_RANK.items())
    return f"CASE {col} {whens} ELSE {len(DETECTOR_RANK)} END"


def merged(findings_sql: str, keys: str) -> str:
    """Window islands: a span opens a new island unless it starts before the
    running maximum end of the spans sorted before it."""
    order = "start, end_, entity, detector, score"
    label_order = "rk, end_ - start DESC, start, entity"
    return (
        f"SELECT {keys}, CAST(min(start) AS INTEGER) AS start, CAST(max(end_) AS INTEGER) AS end_, "
        f"first(entity ORDER BY {label_order}) AS entity, "
        f"first(detector ORDER BY {label_order}) AS detector, max(score) AS score "
        f"FROM (SELECT *, sum(CASE WHEN pmax IS NULL OR start >= pmax THEN 1 ELSE 0 END) "
        f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island "
        f"FROM (SELECT *, max(end_) OVER (PARTITION BY {keys} ORDER BY {order} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmax "
        f"FROM (SELECT *, {rank_case()} AS rk FROM ({findings_sql}) AS f0) AS f1) AS f2) AS f3 "
        f"GROUP BY {keys}, island")


def replacement_sql(style: str) -> str:
    """``style`` is a style name, or ``sql:<expression>`` giving the style per row."""
    if style.startswith("sql:"):
        return (f"CASE {style[4:]} WHEN 'label' THEN '[' || upper(entity) || ']' "
                f"WHEN 'mask' THEN repeat('*', end_ - start) ELSE '' END")
    if style == "label":
        return "'[' || upper(entity) || ']'"
    if style == "mask":
        return "repeat('*', end_ - start)"
    return "''"


def redacted(src: str, keys: str, spans_sql: str, text: str = "text", style: str = "label",
             extra: tuple = ()) -> str:
    """(keys, n_redactions, redacted_text): gaps and replacements in order, then the tail."""
    ks = [k.strip() for k in keys.split(",")]
    on_ds = " AND ".join(f"d.{k} = r.{k}" for k in ks)
    on_ms = " AND ".join(f"m.{k} = s.{k}" for k in ks)
    d_keys = ", ".join(f"d.{k} AS {k}" for k in ks)
    m_keys = ", ".join(f"m.{k}" for k in ks)
    return (
        f"SELECT {d_keys}, CAST(coalesce(r.n, 0) AS INTEGER) AS n_redactions, "
        f"CASE WHEN r.{ks[0]} IS NULL THEN d.{text} "
        f"ELSE r.body || substring(d.{text}, r.last_end + 1) END AS redacted_text "
        f"FROM {src} AS d LEFT JOIN ("
        f"SELECT {keys}, count(*) AS n, max(end_) AS last_end, "
        f"string_agg(substring({text}, pe + 1, start - pe) || {replacement_sql(style)}, '' ORDER BY start) AS body "
        f"FROM (SELECT m.*, s.{text} AS {text}{''.join(f', s.{c} AS {c}' for c in extra)}, "
        f"coalesce(lag(m.end_) OVER (PARTITION BY {m_keys} ORDER BY m.start), 0) AS pe "
        f"FROM ({spans_sql}) AS m JOIN {src} AS s ON {on_ms}) AS g GROUP BY {keys}) AS r "
        f"ON {on_ds}")


def html_text(col: str = "html") -> str:
    """The SQL twin of ``sources.files.html_to_text``."""
    from shroud.sources.files import HTML_ENTITIES
    t = f"regexp_replace({col}, '(?is)<script[^>]*>.*?</script[^>]*>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style[^>]*>.*?</style[^>]*>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?-->', ' ', 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', ' ', 'g')"
    for ent, ch in HTML_ENTITIES:
        t = f"replace({t}, {q(ent)}, {q(ch)})"
    t = f"regexp_replace({t}, '[ \\t\\r\\n]+', ' ', 'g')"
    return f"trim({t})"


PAGES_TEXT = f"(SELECT page_id, {html_text()} AS text FROM pages)"


TOKEN = r"[\p{L}\p{M}\p{N}]+"


def token_rows(src: str, key: str, text: str = "text") -> str:
    """One row per token: key, i (1-based), t (lowered), start, end_ -- offsets
    by a running window sum (linear), not by the Spark route."""
    run = f"sum(length(p) + length(m)) OVER (PARTITION BY {key} ORDER BY i ROWS UNBOUNDED PRECEDING)"
    return (f"SELECT {key}, i, lower(m) AS t, CAST({run} - length(m) AS INTEGER) AS start, "
            f"CAST({run} AS INTEGER) AS end_ FROM (SELECT {key}, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p, "
            f"unnest(range(1, len(ms) + 1)) AS i FROM (SELECT {key}, regexp_extract_all({text}, {q(TOKEN)}) AS ms, "
            f"string_split_regex({text}, {q(TOKEN)}) AS ps FROM {src}) AS a) AS b")


def dictionary(values_sql: str) -> str:
    """(entity, phrase) rows -> entity, first, n, phrase (lowered tokens)."""
    return (f"SELECT DISTINCT entity, toks[1] AS first, len(toks) AS n, array_to_string(toks, ' ') AS phrase "
            f"FROM (SELECT entity, list_transform(regexp_extract_all(phrase, {q(TOKEN)}), lambda x: lower(x)) AS toks "
            f"FROM ({values_sql}) AS v) AS w WHERE len(toks) > 0")


def keyword_values(rows) -> str:
    return " UNION ALL ".join(f"SELECT {q(e)} AS entity, {q(p)} AS phrase" for e, p in rows)


def keyword_findings(src: str, key: str, dict_sql: str, text: str = "text") -> str:
    """key, start, end_, entity, detector for every dictionary phrase occurrence."""
    return (f"(WITH tk AS ({token_rows(src, key, text)}), d AS ({dict_sql}), "
            f"l AS (SELECT {key}, list(t ORDER BY i) AS lt FROM tk GROUP BY {key}) "
            f"SELECT s.{key} AS {key}, s.start AS start, e.end_ AS end_, d.entity AS entity, "
            f"'keyword' AS detector, CAST(1.0 AS DOUBLE) AS score FROM tk AS s JOIN d ON s.t = d.first "
            f"JOIN l ON l.{key} = s.{key} JOIN tk AS e ON e.{key} = s.{key} AND e.i = s.i + d.n - 1 "
            f"WHERE array_to_string(l.lt[s.i:s.i + d.n - 1], ' ') = d.phrase)")


def lexicon_findings(src: str, key: str, spec, text: str = "text") -> str:
    """Whole tokens, as written, that the lexicon scorer's terms name."""
    run = f"sum(length(p) + length(m)) OVER (PARTITION BY {key} ORDER BY i ROWS UNBOUNDED PRECEDING)"
    terms = " UNION ALL ".join(f"SELECT {q(w)} AS w, {q(e)} AS entity" for w, e in sorted(spec.options["terms"].items()))
    return (f"(SELECT {key}, CAST(e - length(m) AS INTEGER) AS start, CAST(e AS INTEGER) AS end_, l.entity AS entity, 'ner' AS detector, "
            f"CAST({spec.options['score']} AS DOUBLE) AS score FROM (SELECT {key}, m, {run} AS e FROM (SELECT {key}, unnest(ms) AS m, "
            f"unnest(ps[1:len(ms)]) AS p, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT {key}, regexp_extract_all({text}, {q(TOKEN)}) AS ms, "
            f"string_split_regex({text}, {q(TOKEN)}) AS ps FROM {src}) AS a) AS b) AS t JOIN ({terms}) AS l ON t.m = l.w)")

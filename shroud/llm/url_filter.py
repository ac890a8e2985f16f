"""URL allow/block lists: a trie over reversed host labels and path segments.

The rules become one nested dict (a few bytes per rule label), which is
broadcast; ``MAX_RULE_BYTES`` bounds it and a larger list is refused rather than
broadcast.  Every URL walks the trie once: host labels from the right, then path
segments, so the cost per URL is its own length whatever the number of rules.

Precedence: the deepest matching host wins, and on that host the longest path
(longest match); if a deeper host has rules but none whose path fits, the next
shallower host is tried.  A tie (the same rule listed as allow and block) is block.

Defined results: null URLs and URLs without ``://`` have empty host and path and
take the default verdict; an empty rule list gives the default to every row;
rows are never merged, so repeated rows stay; extra columns pass through unless
they carry the name of an output column, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bytes of rule text that are broadcast.
MAX_RULE_BYTES = 64 << 20

HOST = r"^[\s\S]*?://([^/?#]*)"
PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_rule(rule: str) -> tuple[str, str]:
    """``net/`` -> (``net``, ``/``): host, then path from the first slash."""
    host, slash, rest = rule.partition("/")
    return host.lower(), slash + rest


def segments(path: str) -> list[str]:
    """``/en/a`` -> [``/``, ``en/``, ``a``]; only the last may lack its slash."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


def build_trie(rules: Iterable[tuple[str, str]]) -> dict:
    """rules: (verdict, rule).  A node is {"kids": host children, "paths": path trie};
    a path node is {"kids", "part": rules ending inside a segment, "rule"}."""
    root: dict = {"kids": {}, "paths": None}
    for verdict, rule in sorted(rules, key=lambda r: r[0] == "block"):
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict must be allow or block, not {verdict!r}")
        host, path = split_rule(rule)
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node["kids"].setdefault(label, {"kids": {}, "paths": None})
        if node["paths"] is None:
            node["paths"] = {"kids": {}, "part": {}, "rule": None}
        p = node["paths"]
        for seg in segments(path):
            if seg.endswith("/"):
                p = p["kids"].setdefault(seg, {"kids": {}, "part": {}, "rule": None})
            else:
                p["part"][seg] = (rule, verdict)
                break
        else:
            p["rule"] = (rule, verdict)
    return root


def longest_path(node: dict, segs: list[str]):
    """Deepest rule of a host's path trie that is a prefix of the path."""
    best = node["rule"]
    for seg in segs:
        fits = [k for k in node["part"] if seg.startswith(k)]
        if fits:
            best = node["part"][max(fits, key=len)]
        node = node["kids"].get(seg)
        if node is None:
            return best
        best = node["rule"] or best
    return best


def match(trie: dict, host: str, path: str):
    """(rule, verdict) of the longest match, or None."""
    chain, node = [trie], trie
    for label in reversed(host.split(".")) if host else ():
        node = node["kids"].get(label)
        if node is None:
            break
        chain.append(node)
    segs = segments(path)
    for node in reversed(chain):
        if node["paths"] is not None and (hit := longest_path(node["paths"], segs)):
            return hit
    return None


def url_filter(df: DataFrame, rules: Iterable[tuple[str, str]], *, url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``df``."""
    rules = list(rules)
    if sum(len(r) + len(v) for v, r in rules) > MAX_RULE_BYTES:
        raise ValueError("rule list is larger than MAX_RULE_BYTES; split it by top-level host label")
    shared = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for part in parts:
            hits = [match(trie, h, p) or (None, default) for h, p in zip(part["host"], part["path"], strict=True)]
            yield pd.DataFrame(hits, columns=["rule", "verdict"], dtype=object)

    url = F.col(url_col)
    out = df.withColumns({
        "_host": F.coalesce(F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER), F.lit("")),
        "_path": F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))})
    out = out.withColumn("_hit", judge(F.struct(F.col("_host").alias("host"), F.col("_path").alias("path"))))
    return (out.drop("host", "path", "rule", "verdict")
            .withColumns({"host": F.col("_host"), "path": F.col("_path"), "rule": F.col("_hit.rule"),
                          "verdict": F.col("_hit.verdict")}).drop("_host", "_path", "_hit"))

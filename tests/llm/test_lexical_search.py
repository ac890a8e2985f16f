import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shroud.llm import lexical_search as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")]


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item, text in set(items):
        scored = []
        for i, b in bags:
            n = sum(b.values())
            score = 0
            for t in terms(text):
                if t in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * (75 + (25 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored)[:k]):
            out.add((item, rank + 1, i, -s))
    return out


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(80)] + ["É", "straße", "日本", "x9"]
    docs = [(i, " ".join(rnd.choice(words[:rnd.choice([6, 30, 84])]) for _ in range(rnd.randint(1, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(90)]  # ties
    docs += [(3, docs[3][1]), (None, docs[9][1]), (None, None), (2000, None), (2001, ""), (2002, " .,!"), (2003, "W1-w1_W1"), (2004, "w5 " * 300_000)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 25)))) for i in range(25)]
    items += [(100, docs[7][1]), (101, None), (102, ""), (103, "unknown words"), (104, "w1 w1 W1 w2"), (100, docs[7][1]), (105, docs[9][1] * 3)]
    return docs, items


def run(spark, make, docs, items, parts=3, **kw):
    d = make([(i, t, "", "", 0) for i, t in docs], parts=parts).selectExpr("*", "1 AS score", "2 AS rank", "'q' AS query", "0 AS item_id")
    q = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS doc", "2 AS score", "3 AS query")
    index, n_docs, _ = L.build_index(d)
    return [tuple(r) for r in L.search(index, n_docs, q, **kw).collect()]


@pytest.mark.parametrize("segment,depth,block", [(4 << 20, 16, 4 << 20), (2_000, 1, 4 << 20), (500, 3, 200)])
def test_against_all_scores(spark, make, monkeypatch, segment, depth, block):
    monkeypatch.setattr(L, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(L, "FIRST_DEPTH", depth)
    monkeypatch.setattr(L, "QUERY_BYTES", block)
    monkeypatch.setattr(L.common, "blocks", lambda items, size_of, limit=1000, f=L.common.blocks: f(items, size_of, min(limit, segment)))
    docs, items = corpus()
    got = run(spark, make, docs, items)
    want = brute(docs, items)
    assert len(got) == len(set(got)) == len(want) and set(got) == want


def test_fewer_than_k_and_empty(spark, make):
    docs, items = corpus(60, 2)
    assert set(run(spark, make, docs, items, k=3)) == brute(docs, items, 3)
    assert run(spark, make, [], items) == []
    assert run(spark, make, docs, []) == []
    # a term that every document holds still weighs a little; of one document it weighs 0
    assert set(run(spark, make, [(1, "a b")], [(1, "a")])) == brute([(1, "a b")], [(1, "a")])


def test_reads_stop_early():
    """A list's tail is not read when nobody can enter any more."""
    n = 5_000
    impacts = np.sort(np.random.default_rng(0).integers(1, 1000, n))[::-1] ** 3
    seg = object.__new__(L.Segment)
    seg.ids, seg.terms, seg.ends, seg.docs = np.arange(n), np.array([5], np.uint64), np.array([n]), np.arange(n, dtype=np.int32)
    read = []

    class Watched:
        def __getitem__(self, at):
            read.append(len(np.atleast_1d(at)))
            return impacts[at]
    seg.impacts = Watched()
    places, scores = seg.search(np.array([5], np.uint64), np.array([2]), 10, 0)
    assert set(scores.tolist()) >= set((2 * impacts[:10]).tolist()) and sum(read) < 200


def test_string_ids_and_null_ids():
    keep = L._best(np.array([5, 7, 7, 7]), np.array(["z", "b", None, "a"], object), 3)
    assert keep.tolist() == [2, 3, 1]


def test_segments_and_row_groups_are_bounded(spark, make, monkeypatch):
    """Documents without text fill a segment too, and a task's segments don't share one row group."""
    from pyarrow import parquet
    monkeypatch.setattr(L, "SEGMENT_BYTES", 1 << 18)
    docs = [(i, f"w{i} x{i} y") for i in range(9_000)] + [(10_000 + i, None) for i in range(3_000)]
    index, _, _ = L.build_index(make([(i, t, "", "", 0) for i, t in docs], parts=1))
    assert max(r[0] for r in index.selectExpr("size(ids)").collect()) <= 2_048
    groups = [m.row_group(i) for f in index.inputFiles() for m in [parquet.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert len(groups) > 1 and max(g.num_rows for g in groups) <= 4

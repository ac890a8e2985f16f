import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shroud.llm import mixing


def targets(sizes, weights, budget, cap):
    """The rule word for word: share, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, done, left = set(names), {}, budget * sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return done | share
        done |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return done


def docs(n=600):
    rows = []
    for i in range(n):
        src = "hot" if i % 3 == 0 else [None, "b", "ä", "Z", "\U0001F600"][i % 5]
        rows.append((i, " ".join(["w"] * (1 + (i * i) % 40)), "en", src, 0))
    return [*rows, (None, "a b", "", "b", 0), (None, None, None, None, None), (7, "", "", "b", 0), (8, " \t\n", "", "none", 0),
            (9, "x\u00a0y z", "", "b", 0)]


def test_targets_sizes_and_copies(make):
    rows = docs()
    got = mixing.mix(make(rows).withColumn("size", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.size == n and r.taken == r.copies * n and r.taken <= 2 * n
        size[r.source] += n
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = targets(size, (3, 1, 2), 1.5, 2.0)
    for s in size:
        assert target[s] == pytest.approx(want[s]), s
        assert abs(taken[s] - target[s]) <= 21, s
    again = mixing.mix(make(rows, parts=7)).collect()
    key = lambda r: (r.doc_id, r.text, r.source, r.taken)
    assert sorted(map(str, map(key, got))) == sorted(map(str, map(key, again)))


def test_all_at_cap_unequal_weights_and_expansion(make):
    rows = [(i, "a b c", "en", "s", 5 if i < 100 else 1) for i in range(300)]
    m = mixing.mix(make(rows), budget=2.0)
    assert {r.copies for r in m.collect()} == {2}
    m = mixing.mix(make(rows), budget=0.5, weight_col="n_chars")
    got = m.collect()
    assert abs(sum(r.taken for r in got) - 450) <= 2
    assert sum(r.copies for r in got if r.n_chars == 5) > 1.3 * sum(r.copies for r in got if r.n_chars == 1)
    taken = mixing.take(make(rows).withColumn("size", F.lit("clash")), budget=0.5, weight_col="n_chars")
    assert taken.columns == ["doc_id", "text", "lang", "source", "n_chars", "size"] and {r.size for r in taken.collect()} == {"clash"}
    assert sorted(r.doc_id for r in taken.collect()) == sorted(r.doc_id for r in got for _ in range(r.copies))


def test_empty_and_no_words(make):
    assert mixing.mix(make([])).count() == 0
    assert [r.taken for r in mixing.mix(make([(1, "", "", "s", 0), (2, None, "", None, 0)])).collect()] == [0, 0]


def test_native_plan(make):
    plan = mixing.mix(make(docs()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

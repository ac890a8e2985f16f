import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from shroud.llm import simhash as S
from shroud.llm.components import components
from shroud.llm.queries import QUERIES


def fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps):
    """Position -> smallest position reachable over links of 3 or fewer bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints(make, monkeypatch):
    monkeypatch.setattr(S, "SHINGLE_BLOCK", 7)
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One", "one", "Two WORDS", "a b c", "a b c d", "É é E e", "x" * 10_000]
    texts += [" ".join(rnd.choice("abcDEFé") for _ in range(rnd.randint(3, 60))) for _ in range(60)]
    got = {r["__id"]: r.fp % (1 << 64) for r in S.fingerprints(make([(i, t, "", "", 0) for i, t in enumerate(texts)])).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}


def some_fps(rnd, n=150):
    out = []
    for _ in range(n):
        f = rnd.getrandbits(64)
        out.append(f)
        for _ in range(rnd.randint(0, 5)):
            g = rnd.choice(out)
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                g ^= 1 << b
            out.append(g)
    return sorted(set(out))


@pytest.mark.parametrize("hot", [1, 512])
def test_links_against_all_pairs(spark, hot):
    rnd = random.Random(hot)
    fps = some_fps(rnd)
    if hot < 512:  # a crowded ball around one fingerprint, in three of four segments of the ring
        c = rnd.getrandbits(64)
        fps = sorted(set(fps[:80]) | {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(60)})
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in S.links(df, hot).collect()]
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in found)
    if hot == 512:
        assert len(found) == sum((a ^ b).bit_count() <= 3 for i, a in enumerate(fps) for b in fps[:i])
    roots = {r.node % (1 << 64): r.root for r in components(S.links(df, hot)).collect()}
    want = groups(fps)
    by = {}
    for f, g in zip(fps, want, strict=True):
        by.setdefault(g, []).append(roots.get(f, signed(f)))
    assert all(len(set(v)) == 1 for v in by.values()) and len({v[0] for v in by.values()}) == len(by)


def test_components_of_long_chains(spark):
    rnd = random.Random(4)
    nodes = rnd.sample(range(1000), 400)
    edges = [(nodes[i], nodes[i + 1]) for i in range(299)] + [(nodes[i], nodes[300]) for i in range(301, 380)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    a, b = nodes[:300], nodes[300:380]
    assert all(got.get(n, n) == min(a) for n in a) and all(got.get(n, n) == min(b) for n in b)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_documents_and_dedup(make):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(10, base), (4, base.replace("w7 ", "w7x ")), (12, base), (12, base), (None, base), (1, "other " * 9), (2, None), (3, ""),
            (None, "alone"), (20, "q w e"), (21, "Q  w\te")]
    fps = [fingerprint(t) for _, t in rows]
    df = make([(i, t, "en", "s", 0) for i, t in rows]).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(-1))
    got = sorted(((r["__id"], r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    g = groups(fps)
    least = {}
    for (i, _), r in zip(rows, g, strict=True):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    assert got == sorted(((i, least[r]) for (i, _), r in zip(rows, g, strict=True)), key=str)
    kept = S.deduplicate(df).collect()
    assert len(kept) == len(set(g)) and {r.doc_id for r in kept} == set(least.values())
    assert kept[0].component_id == -1 and kept[0].fp == "clash"
    assert S.near_duplicates(make([])).count() == 0 and S.deduplicate(make([])).count() == 0


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, d).collect()}
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect())
    fps = [fingerprint(t) for _, t in rows]
    assert got == {i: (f"{f:016x}", rows[g][0]) for (i, _), f, g in zip(rows, fps, groups(fps), strict=True)}

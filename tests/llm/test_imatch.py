import hashlib
import random
import struct

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from shroud.llm import imatch as M

SEED = 42


def xx(values):
    """Spark's hash of an array of longs."""
    h = SEED
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def term_set(t):
    return {signed(xxhash.xxh64_intdigest(w.encode(), SEED)) for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", t.lower())}


def fingerprint(t, lexicon):
    found = term_set(t)
    found = sorted(found & lexicon or found)
    out = [f"{xx(found) if found else xxhash.xxh64_intdigest(t.encode(), SEED):016x}"]
    for g in range(-M.GROUPS // 2, M.GROUPS // 2):
        mine = [x for x in found if x >> (64 - M.GROUP_BITS) == g]
        for j in range(M.LEVELS):
            sub = [x for x in mine if x % (1 << j) == 0]
            out.append(f"{signed(xx(sub)) % 255 + 1:02x}" if sub else "00")
    return "".join(out)


def likeness(a, b):
    if a == b:
        return 1.0
    size = 2 * M.LEVELS
    each = []
    for g in range(M.GROUPS):
        x, y = (f[16 + size * g:16 + size * (g + 1)] for f in (a, b))
        if x.strip("0") or y.strip("0"):
            e = sum(x[2 * j:2 * j + 2] == y[2 * j:2 * j + 2] != "00" for j in range(M.LEVELS))
            each.append(1.0 if x == y else 1 - 2.0 ** -e)
    return sum(each) / len(each) if each else 0.0


def brute(docs):
    texts = [(i, t or "") for i, t in docs]
    # ids ascending, nulls first; rows of one id by the hash of the text
    texts.sort(key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), SEED))))
    df = {}
    for _, t in texts:
        for w in term_set(t):
            df[w] = df.get(w, 0) + 1
    n = len(texts)
    lexicon = {w for w, c in df.items() if max(2, -(-n // 10_000)) <= c <= max(2, int(0.1 * n))}
    prints = [fingerprint(t, lexicon) for _, t in texts]
    out = []
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % n][1]
        half = len(t) // 2
        e = t[:len(t) - half] + following[:half]
        fe = fingerprint(e, lexicon)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), prints[k], fe, likeness(prints[k], fe), likeness(prints[k], prints[(k + 1) % n])))
    return out


def documents():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Éa", "é", "日本語", "x9"]
    rows = [(i * 7 - 300, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 40, 120])))) for i in range(150)]
    rows += [(5000 + i, rows[3][1]) for i in range(60)]  # copies
    rows += [(None, "first w1 w2"), (None, None), (2, ""), (1, None), (7, "...!"), (7, "w3 w4 \U0001F600 w5"), (7, "w3 w4 \U0001F600 w5"),
             (9000, " ".join(words) * 200), (-2**63, "least"), (2**63 - 1, "most w9")]
    return rows


@pytest.mark.parametrize("partitions,limit", [(1, 10**6), (8, 10**6), (5, 0)])
def test_against_brute_force(spark, make, monkeypatch, partitions, limit):
    monkeypatch.setattr(M, "BROADCAST_TERMS", limit)  # 0: the lexicon is joined by shuffle
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = make([(i, t, "", "", 0) for i, t in documents()], parts=4).selectExpr("*", "1 AS __range", "2 AS term", "'x' AS fingerprint", "3 AS df")
        got = M.fingerprint_pairs(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(documents())
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:5], round(r[5], 9), round(r[6], 9))
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))


def test_small_tables(make):
    assert M.fingerprint_pairs(make([])).count() == 0
    r, = M.fingerprint_pairs(make([(1, "a b c d", "", "", 0)])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest() and r.near_next == 1.0
    r, = M.fingerprint_pairs(make([(1, None, None, None, None)])).collect()
    assert (r.n_chars, r.near_edited, r.near_next) == (0, 1.0, 1.0)


def test_near_copies_stand_out(make):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(0, 200, 2):
        w = [rnd.choice(words) for _ in range(150)]
        rows.append((i, " ".join(w), "", "", 0))
        w[70] = "changed"
        rows.append((i + 1, " ".join(w), "", "", 0))
    got = {r.doc_id: r for r in M.fingerprint_pairs(make(rows)).collect()}
    near = [got[i].near_next for i in range(0, 200, 2)]
    far = [got[i].near_next for i in range(1, 200, 2)]
    assert min(near) > 0.85 and max(far) < 0.4
    assert sum(got[i].near_edited > max(far) for i in range(1, 200, 2)) > 50


def test_native_plan(make):
    plan = M.fingerprint_pairs(make([(1, "a b", "", "", 0), (2, "c", "", "", 0)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_text_moves_once(spark, make):
    df = make([(i, f"w{i} w{i + 1}", "", "", 0) for i in range(50)])
    plan = M.with_next(df).select(F.length("__next"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1

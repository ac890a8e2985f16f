import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shroud.llm import common
from shroud.llm import suffix_dedup as S
from shroud.llm.queries import QUERIES


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 2, bool)
        for s in range(len(d) - length + 1):
            if count[d[s:s + length]] > 1:
                gone[s + 1:s + 1 + length] = True
        rest = bytes(b for b, g in zip(d, gone[1:-1], strict=True) if not g)
        out.append((i, len(d), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def texts(rnd, n=60):
    word = lambda: "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rnd.randint(5, 40)) for _ in range(5)]
    out = []
    for i in range(n):
        t = text(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            s = rnd.choice(shared)
            a, b = sorted(rnd.sample(range(len(s) + 1), 2))
            t += rnd.choice([s, s, s[a:b]]) + text(rnd.randint(0, 10))
        out.append((i, t))
    out += [(100, out[3][1]), (101, out[3][1].replace("a", "b", 1)), (101, out[3][1].replace("a", "b", 1)), (None, out[4][1]), (None, None),
            (102, ""), (103, "z" * 500), (104, "xy" * 300), (105, "é" * 100), (106, out[5][1] * 2)]
    return out


@pytest.mark.parametrize("crowd", [1, 50_000])
def test_against_brute_force(spark, make, monkeypatch, crowd):
    rnd = random.Random(crowd)
    rows = texts(rnd)
    monkeypatch.setattr(S, "BLOCK", 700)  # several texts to a block, long texts in pieces
    monkeypatch.setattr(S, "COLLECTION", 20)
    df = make([(i, t, "", "", 0) for i, t in rows]).withColumn("kept", common.F.lit("clash")).withColumn("lo", common.F.lit(1))
    got = S.remove_repeats(df, length=40, gram=8, max_regions=crowd)
    assert "lo" in got.columns
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str) == brute(rows, 40)


def test_construction_against_all_strings():
    rnd = random.Random(8)
    for _ in range(30):
        regions, at = [], []
        for _ in range(rnd.randint(1, 30)):
            left, right = (bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randint(0, 6))) for _ in range(2))
            at.append(len(left))
            regions.append(left + b"anchor" + right)
        length = 8
        found = {(r, s) for r, a, b in zip(*S.repeats_in_collection(regions, np.array(at), length), strict=True) for s in range(a, b + 1)}
        places = Counter((x[s:s + length], s - p) for x, p in zip(regions, at, strict=True) for s in range(len(x) - length + 1))
        assert found == {(r, s) for r, (x, p) in enumerate(zip(regions, at, strict=True))
                         for s in range(len(x) - length + 1) if places[x[s:s + length], s - p] > 1}


def test_empty_table_and_short_texts(make):
    assert S.remove_repeats(make([])).count() == 0
    assert [r.n_removed for r in S.remove_repeats(make([(1, "a", "", "", 0), (2, None, "", "", 0)])).collect()] == [0, 0]


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in common.table(spark, d, "documents").collect()]
    got = sorted(map(tuple, QUERIES["op6_suffix_dedup"](spark, d).collect()), key=str)
    assert got == brute(rows, 400) and sum(r[2] for r in got) > 0


def test_passages_of_over_50_words_by_their_bytes(make):
    """The contract's length is in bytes: a repeated passage of 400 goes whole, one of 399 stays, however many words it has."""
    rnd = random.Random(51)
    fill = lambda k: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(k))
    long, short = (fill(120)[:n - 1] + "z" for n in (400, 399))
    assert len(long.split()) > 50 and len(short.split()) > 50
    rows = [(2 * i + j, f"{fill(80)} {i}{j}{p}{j}{i} {fill(80)}") for i, p in enumerate([long, short]) for j in (0, 1)]
    rows += [(4, fill(300)), (5, fill(60))]
    got = S.remove_repeats(make([(i, t, "", "", 0) for i, t in rows])).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == brute(rows, 400)
    assert [r[2:4] for r in got] == [(400, 1), (400, 1), (0, 0), (0, 0), (0, 0), (0, 0)]

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shroud.llm import bytewords, common, resample
from shroud.llm.queries import QUERIES


def words(t):
    return (t or "").encode().lower().split()


def grams(t):
    """Buckets of a text's words and word pairs, word by word."""
    ids = [int(bytewords.words_of([w.decode()], bytewords.NONSPACE)[0][0]) for w in words(t)]
    one = [int(bytewords.mix(np.array([i], np.uint64))[0]) for i in ids]
    two = [int(bytewords.mix(np.array([(a * 3 + b) % 2**64], np.uint64))[0]) for a, b in zip(ids, ids[1:], strict=False)]
    return [x % resample.BUCKETS for x in one + two]


def corpus():
    rnd = random.Random(2)
    rows = []
    for i in range(200):
        good = i % 3 > 0
        vocab = [f"g{j}" for j in range(40)] if good else [f"b{j}" for j in range(40)]
        rows.append((i, " ".join(rnd.choice(vocab + ["É", "the"]) for _ in range(rnd.randint(5, 60))), "en", "s", int(good)))
    return [*rows, (None, "g1 g2", "", "", 1), (None, None, None, None, None), (500, "", "", "", 0), (501, "g1 " * 4000, "", "", 0),
            (501, "g1 " * 4000, "", "", 0)]


def test_weights_and_selection_against_word_by_word(make, monkeypatch):
    monkeypatch.setattr(common, "BLOCK_BYTES", 100)
    rows = corpus()
    df = make(rows).withColumn("selected", F.lit("clash"))
    got = resample.resample(df, F.col("n_chars") == 1, share=0.5).collect()
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams(r[1]))
        if r[4] == 1:
            target.update(grams(r[1]))
    n, m, b = sum(raw.values()), sum(target.values()), resample.BUCKETS
    weight = lambda t: sum(math.log((target[g] + 1) / (m + b)) - math.log((raw[g] + 1) / (n + b)) for g in grams(t))
    assert len(got) == len(rows)
    for r in got:
        assert r.log_weight == pytest.approx(weight(r.text), abs=1e-6)
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    assert all(r.selected == (r.gumbel_key >= keys[math.ceil(0.5 * len(rows)) - 1]) for r in got)
    good = [r.selected for r in got if r.doc_id is not None and r.doc_id < 200 and r.doc_id % 3]
    assert sum(good) > 0.7 * len(good)


def test_kth_largest(spark):
    rnd = random.Random(1)
    values = [rnd.choice([rnd.gauss(0, 1), 5.0, -1e300, 1e-300, 1e9 + rnd.random()]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 77, 250, 499, 500):
        assert resample.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(df, "x", 501) is None


def test_empty_and_without_target(make):
    assert resample.resample(make([]), F.lit(True), share=0.5).count() == 0
    got = resample.resample(make(corpus()), F.lit(False), k=3).collect()
    assert {r.log_weight for r in got} == {0.0} and 3 <= sum(r.selected for r in got) <= 4


def test_query_prefers_good_documents(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_resample"](spark, d).collect()}
    lab = {r.doc_id: r.quality for r in common.table(spark, d, "labels").collect() if r.doc_id in got}
    share = lambda y: np.mean([got[i].selected for i, q in lab.items() if q == y])
    assert share(1) > 0.9 and share(0) < 0.5

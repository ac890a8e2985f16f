import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shroud.llm import topk as T


def brute(rows, k, every):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, (j, v) in enumerate(ok) if m != n and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def vectors(rnd, n, dim=8):
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(n):
        c, s = rnd.choice(centres), rnd.choice([0.01, 0.3, 1, 1, 30])
        out.append((i, [s * (x + rnd.gauss(0, rnd.choice([0.05, 1]))) for x in c]))
    same = out[5][1]
    out += [(n + i, list(same)) for i in range(60)]  # a very common vector: ties
    out += [(900, [0.0] * dim), (950, [0.0] * dim), (905, [1.0] * 3), (1000, [1.0, 2.0, -3.0]), (1050, [1e9] * dim), (1100, [-x for x in same])]
    return out


@pytest.mark.parametrize("chunk,coordinate", [(16, 0.0), (50, 0.5), (8192, 2.0)])
def test_against_brute_force(spark, monkeypatch, chunk, coordinate):
    monkeypatch.setattr(T, "CHUNK", chunk)
    monkeypatch.setattr(T, "QUERY_BLOCK", 4)
    monkeypatch.setattr(T, "GROUP", 2)
    monkeypatch.setattr(T, "COORDINATE_FROM", coordinate)
    monkeypatch.setattr(T, "CELL_BYTES", 64 * chunk)  # several cells
    rows = vectors(random.Random(chunk), 250)
    bad = [(1150, None), (1200, []), (1250, [None] * 8), (1300, [float("nan")] * 8), (1350, [float("inf")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("norm", F.lit(1))
    got = T.top_k(df.repartition(3), F.col("vec_id") % 25 == 0, k=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 25)


def test_repeated_ids_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    got = T.top_k(df, F.col("vec_id") == 0, k=5).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(0, 0, 65536)] * 2 + [(0, 7, 32768)] * 2
    assert T.top_k(df.limit(0), F.col("vec_id") == 0, k=5).count() == 0

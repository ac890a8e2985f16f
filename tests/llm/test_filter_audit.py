import itertools
import re

import numpy as np
import pytest

from shroud.llm import filter_audit as A

LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """Every order applied to the documents one after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, t, source in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": re.search(r"[#$%&*|]", t) is not None,
                 "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)}
        rows.append((i, source or "", fails))
    out = set()
    for part in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == part]
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if r[2][f]]
                redundant = sum(r[2][f] for r in mine) - len(gone)
                left = [r for r in left if not r[2][f]]
                shapley[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(left), len(gone), redundant, sum(r[2][f] and sum(r[2].values()) == 1 for r in mine),
                              sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)))
        out |= {(*s, shapley[s[1][s[2] - 1]]) for s in steps}
    return out


def documents():
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(i, [long, long + f" {i}", "short", "AB C", "a # b", " ".join(["x"] * 80), "", None][i % 8], "hot" if i % 3 == 0 else [None, "b", ""][i % 3])
            for i in range(120)]
    return rows + [(None, long, "b"), (None, "AB C", None), (5, long, "b"), (5, long, "other"), (5, long, "b"), (0, long, "hot"),
                   (200, "é#" * 30 + long, "only"), (201, "Ä" * 50 + " A" * 2, "only"), (202, "y " * 400_000, "only")]


def test_against_every_order_applied(spark, make):
    docs = documents()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 130, 3)] + [(5, 1, None), (5, None, 1), (None, 1, 1)]
    df = make([(i, t, "en", s, 0) for i, t, s in docs])
    # columns with the operator's own names do not get into its way
    df = df.selectExpr("*", "'x' AS part", "1 AS mask", "'y' AS __hash", "3 AS n", "true AS good", "0 AS toxic", "1 AS quality")
    lab = spark.createDataFrame(labels, LABELS).selectExpr("*", "'z' AS part", "7 AS mask")
    got = A.audit(df, lab).collect()
    assert len(got) == len(set(map(tuple, got))) == 120 * 5 * len({s or "" for _, _, s in docs})
    assert set(map(tuple, got)) == brute(docs, labels)


def test_empty_tables(spark, make):
    assert A.audit(make([]), spark.createDataFrame([], LABELS)).count() == 0
    got = A.audit(make([(1, None, None, None, None)]), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 600 and {r.part for r in got} == {""} and {r.removed for r in got} == {0, 1}


@pytest.mark.parametrize("m", [1, 3, 5])
def test_gray_walk_against_recount(m):
    rng = np.random.default_rng(m)
    cells = rng.integers(0, 9, (1 << m, 3))
    states = A.gray_states(cells)
    for active in range(1 << m):
        assert (states[active] == cells[[x for x in range(1 << m) if not x & active]].sum(axis=0)).all()


def test_number_of_filters(spark):
    with pytest.raises(ValueError):
        A.walk(spark.createDataFrame([], "part string, mask int, n bigint, good bigint, toxic bigint"), "ABCDEFG")

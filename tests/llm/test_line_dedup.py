import random

import pytest
from pyspark.sql import functions as F

from shroud.llm import line_dedup as L


def one_edit(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def brute(rows, least):
    flat = [(i is None, i, n, line) for i, t in rows if t is not None for n, line in enumerate(t.split("\n")) if line.strip(" \t\r")]
    flat.sort(key=lambda x: (x[0], x[1] or 0, x[2]))
    gone = {}
    for k, (_, i, n, line) in enumerate(flat):
        if any(x[3] == line or (min(len(line), len(x[3])) >= least and one_edit(line, x[3])) for x in flat[:k]):
            gone.setdefault(i, set()).add(n)
    return sorted(((i, len(t.split("\n")) if t is not None else 0, len(gone.get(i, ())), sorted(gone.get(i, ()))) for i, t in rows), key=str)


def edit(rnd, s):
    i, kind = rnd.randint(0, len(s)), rnd.randrange(3)
    c = rnd.choice("abé日")
    return s[:i] + c + s[i:] if kind == 0 else s[:i] + c + s[i + 1:] if kind == 1 else s[:i] + s[i + 1:]


def texts(seed):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("ab é") for _ in range(rnd.choice([1, 5, 6, 7, 8, 12, 30, 31, 200]))) for _ in range(30)] + ["aaaaaaaa", "abababab", "", "  \t"]
    rows = []
    for i in rnd.sample(range(1000), 40):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            s = rnd.choice(pool)
            for _ in range(rnd.randint(0, 2)):
                s = edit(rnd, s)
            lines.append(s)
        rows.append((i, "\n".join(lines)))
    return rows + [(None, pool[3] + "\nonly here, once\r"), (2000, None), (2001, ""), (2002, "\n\n"), (2003, edit(rnd, "q" * 3000) + "\n" + "q" * 3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(make, monkeypatch, seed):
    monkeypatch.setattr(L, "MIN_CHARS", 6)
    rows = texts(seed)
    df = make([(i, t, "", "", 0) for i, t in rows]).withColumn("h", F.lit("clash")).withColumn("dropped", F.lit("clash"))
    got = L.line_report(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 6)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    kept = {r.doc_id: r.text for r in L.deduplicate_lines(df).collect()}
    for i, t, _, gone in ((r[0], dict(rows)[r[0]], r[2], r[3]) for r in brute(rows, 6)):
        assert kept[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone))


def test_repeated_rows_and_empty_table(make):
    line = "a line that is long enough to match"
    got = L.line_report(make([(1, line + "\nx", "", "", 0), (1, line + "\nx", "", "", 0), (2, line + "!", "", "", 0)])).collect()
    assert sorted((r.doc_id, r.n_lines, r.dropped) for r in got) == [(1, 2, []), (1, 2, []), (2, 1, [0])]
    assert L.line_report(make([])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits,least", [(1, 1), (2, 1), (2, 6), (3, 1)])
def test_edit_bound_and_short_lines(make, edits, least):
    rnd = random.Random(10 * edits + least)
    size = (lambda: rnd.choice([1, 2, 3, 5, 8, 19, 20, 40])) if edits < 3 else (lambda: rnd.choice([1, 2, 4, 6, 9, 12]))
    pool = ["".join(rnd.choice("abcdefghé日 ") for _ in range(size())) for _ in range(14)]
    rows = []
    for i in rnd.sample(range(100), 14):
        lines = []
        for _ in range(rnd.randint(0, 4)):
            s = rnd.choice(pool)
            for _ in range(rnd.randint(0, edits + 1)):
                s = edit(rnd, s)
            lines.append(s)
        rows.append((i, "\n".join(lines)))
    if edits == 2:
        long = "".join(rnd.choice("abcdefgh ") for _ in range(200))
        rows += [(200, long), (201, "X" + long[:150] + "Y" + long[151:]), (202, long[1:90] + long[91:]), (203, long[3:])]
    flat = sorted((i, n, line) for i, t in rows for n, line in enumerate(t.split("\n")) if line.strip(" \t\r"))
    gone = {}
    for k, (i, n, line) in enumerate(flat):
        if any(x == line or (min(len(x), len(line)) >= least and distance(x, line) <= edits) for _, _, x in flat[:k]):
            gone.setdefault(i, []).append(n)
    got = L.line_report(make([(i, t, "", "", 0) for i, t in rows]), edits=edits, min_chars=least).collect()
    assert {r.doc_id: r.dropped for r in got} == {i: gone.get(i, []) for i, _ in rows}
    assert gone

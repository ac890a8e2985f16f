import hashlib
import random
import re

import numpy as np

from shroud.llm import bytewords, common
from shroud.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    wins = [(str(i) if i is not None else "null", w[k:k + min(10, len(w))]) for i, t in items
            for w in [words(t)] if w for k in range(len(w) - min(10, len(w)) + 1)]
    for i, t in docs:
        w = words(t)
        hit, names = set(), set()
        for name, g in wins:
            for k in range(len(w) - len(g) + 1):
                if w[k:k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    names.add(name)
        names = sorted(names)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def data(seed=5):
    rnd = random.Random(seed)
    vocab = ["the", "of", "a", "Été", "x9", "ß", "日本", "run", "zoo"] + [f"w{i}" for i in range(30)]
    text = lambda n: rnd.choice([" ", "-", "\x00", "\n"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(25)] + [(None, text(12)), (3, text(12)), (3, text(12)), (99, None), (98, "!!"), (97, "the the the the the the the the the the the")]
    docs = []
    for i in range(120):
        t = text(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            t += " " + (rnd.choice(items)[1] or "").upper() + "; " + text(rnd.randint(0, 8))
        docs.append((i, t))
    return docs + [(None, "no id " + items[3][1]), (None, None), (7, ""), (8, "the " * 50), (8, "the " * 50), (9, "x" * 5000)], items


def check(spark, make, docs, items):
    df = make([(i, t, "en", "s", 0) for i, t in docs]).withColumn("n_hit", common.F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.contamination(D.phrase_hits(D.build_index(df), bench)).drop("__th").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    return df, bench


def test_against_brute_force(spark, make):
    docs, items = data()
    df, bench = check(spark, make, docs, items)
    bad = {(i, t) for (i, t), r in zip(docs, [brute([d], items)[0] for d in docs], strict=True) if r[5]}
    kept = D.decontaminate(df, bench).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted((d for d in docs if d not in bad), key=str)


def test_small_segments_and_several_query_blocks(spark, make, monkeypatch):
    docs, items = data(6)
    monkeypatch.setattr(D, "SEGMENT_BYTES", 200)
    monkeypatch.setattr(D, "QUERY_BYTES", 300)
    check(spark, make, docs, items)


def test_empty_tables(spark, make):
    docs, items = data()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert D.phrase_hits(D.build_index(make([])), bench).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = D.contamination(D.phrase_hits(D.build_index(make([(1, "a b", "", "", 0)])), none)).collect()
    assert [(r.n_words, r.n_hit, r.items_sha256) for r in got] == [(2, 0, hashlib.sha256(b"").hexdigest())]


def test_proximity(spark, make):
    docs, _ = data()
    queries = ["the ß", "w3 zoo été", "absent the", "", "run"]
    got = {tuple(r) for r in D.proximity_hits(D.build_index(make([(i, t, "", "", 0) for i, t in docs if i is not None])), queries, 4)
           .select("query", "__id").distinct().collect()}
    df = {}
    for q, text in enumerate(queries):
        terms = set(words(text))
        for i, t in docs:
            w = words(t)
            if terms and terms <= set(w) and i is not None:
                df[q, i] = [w, terms]
    ok = lambda w, terms, r: any(all(any(w[j] == t for j in range(max(0, p - 4), min(len(w), p + 5))) for t in terms)
                                 for p in range(len(w)) if w[p] == r)
    want_any = {k for k, (w, terms) in df.items() if any(ok(w, terms, r) for r in terms)}
    want_all = {k for k, (w, terms) in df.items() if all(ok(w, terms, r) for r in terms)}
    assert want_all <= got <= want_any and got  # the centre is the rarest term of the document's segment


def test_words_of_matches_the_pattern():
    texts = data()[0]
    texts = [t for _, t in texts] + ["A" * 100, "é" * 60 + " b", "x" * 300]
    for block in (16, 1 << 20):
        ids, n = bytewords.words_of(texts, bytewords.ALNUM, block)
        want = [words(t) for t in texts]
        assert n.tolist() == list(map(len, want))
        flat = [w for ws in want for w in ws]
        seen = {}
        for w, i in zip(flat, ids.tolist(), strict=True):
            assert seen.setdefault(w, i) == i
        assert len(set(seen.values())) == len(seen)
        ids, n = bytewords.words_of(texts, bytewords.NONSPACE, block)
        assert n.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert np.unique(bytewords.mix(np.arange(1000, dtype=np.uint64))).size == 1000


def test_row_groups_of_the_index_are_bounded(spark, make, monkeypatch):
    """Spark reads up to 4,096 rows of a row group at once, so a task's segments must not share one."""
    from pyarrow import parquet
    monkeypatch.setattr(D, "SEGMENT_BYTES", 2_000)
    index = D.build_index(make([(i, f"w{i} " * 200, "", "", 0) for i in range(120)], parts=1))
    groups = [m.row_group(i) for f in index.inputFiles() for m in [parquet.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == index.count() >= 50
    assert max(g.num_rows for g in groups) <= 4


def test_windows_in_small_parts(spark, make, monkeypatch):
    docs, items = data(7)
    monkeypatch.setattr(D, "PART_WINDOWS", 7)
    monkeypatch.setattr(D, "CANDIDATES", 5)
    check(spark, make, docs, items)


def test_windows_of_equal_codes_stay_apart(monkeypatch):
    """Windows are told apart by their words, whatever their codes."""
    texts = ["a b c", "b c a d b c", "a b c d", None, "a b c"]
    for mixed in (D.mix, lambda h: h * np.uint64(0)):
        monkeypatch.setattr(D, "mix", mixed)
        got = D.item_windows([1, 2, 3, 4, None], texts, 3)
        codes = {w: int(bytewords.words_of([w], bytewords.ALNUM)[0][0]) for w in "abcd"}
        found = {}
        for _, rows, first, ends, owners in got.parts():
            for w, row in enumerate(rows.tolist(), first):
                found.setdefault(tuple(row), set()).update(got.names[i] for i in owners[ends[w - 1] if w else 0:ends[w]])
        key = lambda s: tuple(codes[c] for c in s)
        assert found == {key("abc"): {"1", "3", "null"}, key("bca"): {"2"}, key("cad"): {"2"}, key("adb"): {"2"},
                         key("dbc"): {"2"}, key("bcd"): {"3"}}

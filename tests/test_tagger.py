"""The learnt span scorer: decoding against brute force, learning on unseen names, defined results."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from shroud.functions.spans import FINDINGS_DDL
from shroud.operators import ner as N
from shroud.operators import tagger as T


def _score(emit, path, moves):
    total = sum(emit[t, g] for t, g in enumerate(path))
    for t, g in enumerate(path):
        if g and g % 2 == 0:
            last = path[t - 1] if t else 0
            if last not in (g - 1, g):
                return None
            total += moves[int(last == g), g // 2 - 1]
    return total


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(5)
    for n_labels in (1, 2):
        k = 2 * n_labels + 1
        lengths = np.array([1, 2, 4, 4, 3])
        emit = rng.integers(-4, 5, (5, 4, k)).astype(np.float32)
        moves = rng.integers(-4, 5, (2, n_labels)).astype(np.float32)
        got = T.viterbi(emit, lengths, moves)
        for r, n in enumerate(lengths):
            best = max(s for p in itertools.product(range(k), repeat=int(n)) if (s := _score(emit[r], p, moves)) is not None)
            assert _score(emit[r], got[r, :n].tolist(), moves) == best
            assert not got[r, n:].any()


def test_scores_are_the_sum_of_features():
    """A batch of lines scores as a plain recount of every token's features does."""
    rng = np.random.default_rng(6)
    weights = rng.normal(size=(3, 64, 5)).astype(np.float32)
    words = [[" Ab", " c", "."], [" x"], [" Ab", " Ab"]]
    lines = T._Lines(words, 64)
    padded, lengths = lines.windows([0, 1, 2])
    emit = T.emissions(lines.scores(weights), padded)
    for r, ws in enumerate(words):
        around = [T.EDGE, *ws, T.EDGE]
        for t in range(len(ws)):
            plain = sum(weights[d, f] for d in range(3) for f in T._features(around[t + d], 64))
            assert np.allclose(emit[r, t], plain, atol=1e-5)


def test_skipped_lines_have_no_span():
    """Lines left out of the decoding are those whose best path is O throughout."""
    rng = np.random.default_rng(8)
    labels = ("a", "b")
    weights = rng.normal(-0.02, 0.3, size=(3, 256, 5)).astype(np.float32)
    weights[:, :, 0] += 0.1
    scorer = T.TaggerScorer(T.scorer_spec(T.TaggerModel(labels, weights, rng.normal(size=(2, 2)).astype(np.float32))))
    words = [T.words_of(" ".join(rng.choice(["Ab", "c.", "x1", "(y)", "Zed"], rng.integers(1, 4))), scorer.token) for _ in range(300)]
    lines = T._Lines(words, 256)
    scores = lines.scores(weights)
    marked = set(scorer._marked(lines, scores).tolist())
    padded, lengths = lines.windows(range(300))
    spans = T.viterbi(T.emissions(scores, padded), lengths, scorer.model.moves).any(axis=1)
    assert 0 < len(marked) < 300 and set(np.flatnonzero(spans).tolist()) <= marked


def test_words_and_places():
    token = T._token_re()
    line = "Dr  Ané-1,\tx\u00a0y"
    assert [line[a:b] for a, b in T.places_of(line, token)] == ["Dr", "Ané", "-", "1", ",", "x", "y"]
    assert [T._bare(w) for w in T.words_of(line, token)] == ["Dr", "Ané", "-", "1", ",", "x", "y"]
    assert T.words_of("", token) == [] and T.words_of("  ", token) == []


def _sentences(names, places, n, seed):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        name, place = rnd.choice(names), rnd.choice(places)
        lead = rnd.choice(["Yesterday ", "", "We know that "])
        text = f"{lead}Dr {name} travelled to {place} by train.\n{rnd.choice(['Nothing else.', 'The End of it', 'by Train'])}"
        a, b = len(lead) + 3, text.index(" travelled")
        c = text.index(" to ") + 4
        rows.append((i, text, [(a, b, "person", "review", 1.0), (c, c + len(place), "location", "review", 1.0)]))
    return rows


def _fit(spark, rows, **kw):
    df = spark.createDataFrame(rows, f"doc_id int, text string, findings {FINDINGS_DDL}")
    return T.fit(df, shards=2, epochs=3, **kw)


def test_learns_context_not_only_words(spark):
    train = _sentences(["Ada Long", "Bo Reed", "Carl Moss", "Dee Fox"], ["Rome", "Oslo", "Bonn"], 200, 1)
    test = _sentences(["Zed Ulm", "Quin Yale"], ["Lyon", "Turin"], 40, 2)
    model = _fit(spark, train)
    assert model.labels == ("location", "person")
    df = spark.createDataFrame(test, f"doc_id int, text string, findings {FINDINGS_DDL}")
    out = N.detect_ner(df, "text", T.scorer_spec(model)).collect()
    right = sum((f.start, f.end, f.entity) in {(s.start, s.end, s.entity) for s in r.ner} for r in out for f in r.findings)
    found = sum(len(r.ner) for r in out)
    assert right >= 0.95 * 80 and found <= 1.05 * 80
    assert _fit(spark, list(reversed(train))).version == model.version     # order of rows doesn't matter
    assert _fit(spark, train + train).version == model.version             # repeated lines count once
    alone = T.TaggerScorer(T.scorer_spec(model))
    for r in out:                                                           # a batch gives what single texts give
        assert [(s.start, s.end, s.entity) for s in r.ner] == [s[:3] for s in alone.predict(r.text)]


def test_defined_results(spark):
    model = _fit(spark, _sentences(["Ada Long"], ["Rome"], 30, 1))
    scorer = T.TaggerScorer(T.scorer_spec(model))
    assert scorer.predict_all([None, "", "\n\n", "   "]) == [[], [], [], []]
    long = "word " * 40_000 + "Dr Ada Long travelled to Rome by train."
    spans = scorer.predict(long)                                            # one line of 200 kB, never cut
    assert {(long[a:b], e) for a, b, e, _ in spans} >= {("Ada Long", "person"), ("Rome", "location")}
    empty = spark.createDataFrame([], f"doc_id int, text string, findings {FINDINGS_DDL}")
    none = T.fit(empty)
    assert none.labels == () and T.TaggerScorer(T.scorer_spec(none)).predict("Dr Ada Long") == []
    unmarked = spark.createDataFrame([(1, "Ada Long", None), (2, None, None)], empty.schema)
    assert T.fit(unmarked).labels == ()
    kept = T.fit(unmarked, labels=("person",))
    assert T.TaggerScorer(T.scorer_spec(kept)).predict("Ada Long") == []
    # extra columns with clashing names
    rows = spark.createDataFrame(_sentences(["Ada Long"], ["Rome"], 30, 1), empty.schema)
    for c in ("t", "f", "h", "line", "shard"):
        rows = rows.withColumn(c, F.lit("x"))
    assert T.fit(rows, shards=2, epochs=3).version == model.version


def test_labelled_lines_cut_at_line_ends(spark):
    df = spark.createDataFrame([(1, "ab cd\nef\n\ngh", [(3, 8, "x", "d", 1.0), (10, 12, "y", "d", 1.0)])],
                               f"doc_id int, text string, findings {FINDINGS_DDL}")
    got = sorted((r.line, list(r.starts), list(r.ends), list(r.entities)) for r in T.labelled_lines(df, "text", "findings").collect())
    assert got == [("ab cd", [3], [5], ["x"]), ("ef", [0], [2], ["x"]), ("gh", [0], [2], ["y"])]


def test_sample_of_a_task_equals_sorting_all_lines():
    import pyarrow as pa
    rnd, rows = random.Random(3), []
    for _ in range(600):
        h = rnd.randint(0, 60)
        rows.append({"line": f"{h} {rnd.choice('ab')}", "starts": [0] if h % 3 == 0 else [], "ends": [1] if h % 3 == 0 else [],
                     "entities": ["x"] if h % 3 == 0 else [], "h": h})
    schema = pa.schema([("line", pa.string()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                        ("entities", pa.list_(pa.string())), ("h", pa.int64())])
    batches = [pa.RecordBatch.from_pylist(rows[i:i + 50], schema) for i in range(0, 600, 50)]
    for marked, plain in ((5, 9), (1, 1), (1000, 1000), (0, 3)):
        got = [r for b in T._smallest(marked, plain)(iter(batches)) for r in b.to_pylist()]
        key = lambda want: sorted({(r["h"], r["line"]) for r in rows if bool(r["starts"]) == want})
        assert sorted((r["h"], r["line"]) for r in got) == sorted(key(True)[:marked] + key(False)[:plain])
    assert not list(T._smallest(2, 2)(iter([])))


def test_fitting_reads_the_texts_once(spark, tmp_path):
    spark.createDataFrame([(f"mail to Anon{i} now\nplain line {i}\n",) for i in range(60)], "text string").write.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f
    df = spark.read.parquet(str(tmp_path / "t")).mapInPandas(count, "text string")
    found = df.selectExpr("text", "array(named_struct('start', 8, 'end', 12, 'entity', 'person', 'detector', 'x', 'score', 1.0D)) AS findings")
    model = T.fit(found, epochs=1, shards=2, max_marked=20, max_plain=20)
    assert model.labels == ("person",) and seen.value == 60


def _many(n):
    rows = [(i, f"Dr Name{i} left at {i}.\nplain line {i}\n", [(3, 7 + len(str(i)), "person", "review", 1.0)]) for i in range(n)]
    return [*rows, (n, "word " * 1_200 + "by Acme.", [(6_003, 6_007, "organization", "review", 1.0)]), *rows[:50]]


def test_fit_learns_from_all_lines(spark, monkeypatch):
    """No line is left out: not by a number of lines, not by its length."""
    seen, packed = [], T._packed
    monkeypatch.setattr(T, "_packed", lambda lines, *a: seen.append(lines.collect()) or packed(lines, *a))
    df = spark.createDataFrame(_many(2_300), f"doc_id int, text string, findings {FINDINGS_DDL}")
    model = T.fit(df, epochs=1)
    assert model.labels == ("organization", "person")
    assert len(seen[0]) == 2 * 2_300 + 1 and sum(len(r.starts) for r in seen[0]) == 2_300 + 1
    assert max(len(r.line) for r in seen[0]) == 6_008


def test_shards_grow_with_the_lines_and_are_averaged(spark, monkeypatch):
    """The model is the mean over the shards, whose number follows the distinct lines, not the rows or their order."""
    monkeypatch.setattr(T, "SHARD_CHARS", 3_000)
    rows = _many(200)
    df = spark.createDataFrame(rows, f"doc_id int, text string, findings {FINDINGS_DDL}")
    lines = T.labelled_lines(df, "text", "findings").selectExpr("*", "xxhash64(line, starts, ends, entities) AS h").distinct().collect()
    n = -(-sum(len(r.line) for r in lines) // 3_000)
    assert n > 4
    labels = ("organization", "person")
    shards = [T.Shard(T.Shard.pack([r[:4] for r in sorted((r for r in lines if r.h % n == k), key=lambda r: (r.h, r.line))], labels)) for k in range(n)]
    shards = [x for x in shards if len(x.lengths)]
    weights, moves = np.zeros((3, T.DIM, 5), np.float32), np.zeros((2, 2), np.float32)
    for _ in range(2):
        w, m, aw, am = (np.mean(x, axis=0, dtype=np.float64) for x in zip(*(T.train_epoch(s, weights, moves) for s in shards), strict=True))
        weights, moves = w.astype(np.float32), m.astype(np.float32)
    model = T.fit(df, epochs=2)
    assert np.allclose(model.weights, aw, atol=1e-5) and np.allclose(model.moves, am, atol=1e-5) and model.weights.any()
    again = spark.createDataFrame(rows[::-1] * 2, df.schema).repartition(3)
    assert T.fit(again, epochs=2).version == model.version


def test_wrong_lines_are_those_whose_best_path_differs(monkeypatch):
    rng = np.random.default_rng(9)
    labels, words = ("a", "b"), ["Ab", "c.", "x1", "(y)", "Zed"]
    rows = []
    for _ in range(200):
        line = " ".join(rng.choice(words, rng.integers(1, 9)))
        rows.append((line, [0], [2], [rng.choice(["a", "other"])]) if rng.random() < 0.3 else (line, [], [], []))
    rows += [("", [], [], []), ("x1 " * 300, [], [], [])]
    shard = T.Shard(T.Shard.pack(rows, labels, 256))
    assert len(shard.lengths) == 201
    weights = rng.normal(-0.02, 0.3, size=(3, 256, 5)).astype(np.float32)
    weights[:, :, 0] += 0.1
    moves = rng.normal(size=(2, 2)).astype(np.float32)
    token, want = T._token_re(), []
    for i, (line, *spans) in enumerate([r for r in rows if r[0]]):
        lines = T._Lines([T.words_of(line, token)], 256)
        padded, lengths = lines.windows([0])
        gold = T._gold(T.places_of(line, token), *spans, labels)
        if (T.viterbi(T.emissions(lines.scores(weights), padded), lengths, moves)[0] != gold).any():
            want.append(i)
    for cells in (1 << 16, 100):
        monkeypatch.setattr(T, "CELLS", cells)
        groups = list(T._groups(shard.lengths, 30))
        assert [a for a, _ in groups] == [0, *(b for _, b in groups[:-1])] and groups[-1][1] == 201
        assert [i for a, b in groups for i in T._wrong(shard, a, b, weights, moves)] == want
    assert 0 < len(want) < 201

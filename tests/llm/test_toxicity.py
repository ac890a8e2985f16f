import random
import zlib

import pytest
from pyspark.sql import functions as F

from shroud.llm import common, toxicity
from shroud.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def auc(pairs):
    """Probability that a toxic row scores higher (ties half)."""
    bad, good = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))


def corpus(n=900, seed=3):
    rnd = random.Random(seed)
    syll = ["ta", "ren", "sol", "mi", "ka", "ter", "on", "ve", "lu", "ish"]
    word = lambda: "".join(rnd.choice(syll) for _ in range(rnd.randint(1, 4)))
    rows = []
    for i in range(n):
        toxic = i % 6 == 0
        words = [word() for _ in range(rnd.randint(30, 200))]
        if toxic:
            for _ in range(rnd.randint(2, 8)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["zgrobnik", "Wuxpfah", "qqadder"]) + rnd.choice(["", "s", ","]))
        rows.append((i, " ".join(words), "en", "s", 0, int(toxic)))
    return rows


def test_held_out_accuracy(spark, make):
    rows = corpus()
    docs = make([r[:5] for r in rows])
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.withColumn("score", F.lit("clash")), model).collect()
    y = {r[0]: r[5] for r in rows}
    held = [(r.score, y[r.doc_id]) for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert auc(held) > 0.97
    assert all((r.score >= 0.7) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(p >= 0.7 and not t for p, t in held) <= 0.02 * len(held)


def rare_corpus(n=3600, vocabulary=400, seed=5):
    """Every third text is toxic by four words of a large vocabulary; each stands in about 1% of the toxic texts."""
    rnd = random.Random(seed)
    syll = ["ta", "ren", "sol", "mi", "ka", "ter", "on", "ve", "lu", "ish"]
    bad = ["".join(rnd.choice("bdfgpqxz") + rnd.choice("aeiou") for _ in range(rnd.randint(3, 5))) for _ in range(vocabulary)]
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice(syll) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(30, 80))]
        if i % 3 == 0:
            for w in rnd.sample(bad, 4):
                words.insert(rnd.randrange(len(words)), w)
        rows.append((i, " ".join(words), "en", "s", 0, int(i % 3 == 0)))
    return rows


def test_large_vocabulary_of_rare_toxic_words(spark, make):
    rows = rare_corpus()
    docs = make([r[:5] for r in rows])
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.toxic) > 2_048
    y = {r[0]: r[5] for r in rows}
    held = [(r.score, y[r.doc_id]) for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert auc(held) > 0.97
    assert sum(p >= 0.7 for p, t in held if t) >= 0.9 * sum(t for _, t in held)
    assert sum(p >= 0.7 and not t for p, t in held) <= 0.02 * len(held)


def test_learns_only_from_rows_not_held_out(spark, make):
    rows = corpus(300)
    docs = make([r[:5] for r in rows])
    flip = [(r[0], 1, 1 - r[5] if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r[5]) for r in rows]
    models = [toxicity.fit(docs, spark.createDataFrame(lab, "doc_id bigint, quality int, toxic int"))
              for lab in ([(r[0], 1, r[5]) for r in rows], flip)]
    assert models[0].toxic == models[1].toxic and models[0].ordinary == models[1].ordinary
    assert (models[0].weights == models[1].weights).all()


def test_nulls_empty_long_and_repeated(spark, make):
    rows = corpus(300)
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(make([r[:5] for r in rows]), labels)
    odd = [(None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (2, "x" * 300_000, "", "", 0), (3, " \n", "", "", 0),
           (4, "ta ren " * 50_000, "", "", 0)]
    got = toxicity.score(make(odd), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert toxicity.score(make([]), model).count() == 0


def test_without_labels_of_both_classes(spark, make):
    rows = corpus(40)
    for lab in ([], [(r[0], 1, 0) for r in rows]):
        model = toxicity.fit(make([r[:5] for r in rows]), spark.createDataFrame(lab, "doc_id bigint, quality int, toxic int"))
        assert {r.score for r in toxicity.score(make([r[:5] for r in rows]), model).collect()} == {0.0}


@pytest.mark.parametrize("sf", [SF])
def test_query_on_given_tables(spark, sf):
    got = QUERIES["op1_toxicity"](spark, sf).collect()
    assert len(got) == common.table(spark, sf, "documents").count()
    y = {r.doc_id: r.toxic for r in common.table(spark, sf, "labels").collect()}
    held = [(r.score, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert auc(held) > 0.9


def test_sample_is_of_ids_with_texts_and_one_text_per_id(spark, make, monkeypatch):
    rows = corpus(300)
    seen = []
    learn = toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda sample, counts, base: seen.append(sample) or learn(sample, counts, base))
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 30)
    monkeypatch.setattr(toxicity, "MAX_ORDINARY", 150)
    hot = next(r for r in rows if r[5] and zlib.crc32(str(r[0]).encode()) % 3 != 1)
    docs = make([r[:5] for r in rows] + [hot[:5]] * 150)
    # most labelled ids have no document, or only one that is too long
    missing = [(i, 1, i % 2) for i in range(10_000, 12_000)]
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows] + missing, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs.union(make([(i, "x" * 40_000, "", "", 0) for i in range(10_000, 10_050)])), labels)
    assert len(seen[0]) == 180 and sum(y for y, _ in seen[0]) == 30
    assert sum(t == hot[1] for _, t in seen[0]) <= 1 and model.toxic


def test_too_few_texts_are_logged(spark, make, caplog):
    rows = corpus(40)
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id bigint, quality int, toxic int")
    with caplog.at_level("WARNING"):
        model = toxicity.fit(make([r[:5] for r in rows if not r[5]]), labels)
    assert not model.toxic and "too few to learn from" in caplog.text

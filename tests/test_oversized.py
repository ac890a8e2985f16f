"""Texts cut over many tasks against the unsplit scan."""

import random

import pytest
from pyspark.sql import functions as F

from shroud.operators import detect as D
from shroud.operators import keywords as K
from shroud.operators import oversized as O
from shroud.operators import redact as R
from tests.test_linear_scan import ALPHABET

PHRASES = [("k", "one two three four five six"), ("k", "a"), ("l", "é 22"), ("l", "password"), ("k", "x, y; z")]


def texts(seed):
    rnd = random.Random(seed)
    words = ALPHABET + ["one", "two", "three four", "five", "six", ",", ";", "!", " ", " ", " ", "x", "y", "z", "password", "\n"]
    out = ["".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 10, 80, 400]))) for _ in range(120)]
    out += ["one two three\nfour, five; six", "one, two! three? four\n\n\n\n\n,,,,,,five six", ",;!\n" * 30, "w " * 300, "1 22 " * 200,
            "x" * 500 + "\n" + "a@b.cc", "😀," * 200 + " token = \"" + "a" * 20 + "\""]
    return out


def frame(spark, ts):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ts)] + [(1, ts[1]), (1, ts[1]), (3, None), (None, None)]
    return spark.createDataFrame(rows, "doc_id int, text string").withColumn("part", F.lit("clash")).withColumn("__x", F.lit(1))


def rows(df, *cols):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "text", "part", *cols).collect())


@pytest.mark.parametrize("chars", [1, 7, 50])
def test_same_findings_as_the_unsplit_scan(spark, chars):
    df = frame(spark, texts(chars))
    words = spark.createDataFrame(PHRASES, K.DICT_SCHEMA)
    got = O.detect_in_pieces(df, ["doc_id"], dictionary=words, piece_chars=chars)
    want = K.detect_keywords(D.detect_patterns(df, "text"), "text", words)
    assert rows(got, F.array_sort("findings")) == rows(want, F.array_sort("findings"))
    for style in R.STYLES:
        cut = O.redact_in_pieces(want, ["doc_id"], style=style, piece_chars=chars)
        whole = R.apply_redactions(want, style=style)
        assert rows(cut, "redacted_text") == rows(whole, "redacted_text")


def test_rows_are_divided_by_size(spark):
    df = frame(spark, texts(4))
    got = O.detect(df, ["doc_id"], limit=100, piece_chars=40)
    assert rows(got, F.array_sort("findings")) == rows(D.detect_patterns(df, "text"), F.array_sort("findings"))
    merged = D.merge(got)
    done = O.redact(merged, ["doc_id"], limit=100, piece_chars=40)
    assert rows(done, "redacted_text") == rows(R.apply_redactions(merged, merged=True), "redacted_text")
    assert O.detect(df.limit(0), ["doc_id"]).count() == 0


def test_one_large_text_becomes_many_tasks(spark):
    text = ("Some words and more words without an end " * 20 + "mail a@b.cc, call +1 (555) 123-4567. ") * 2500  # 2 MB
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    pieces = O.cut(df, ["doc_id"], "text", piece_chars=1 << 16)
    tasks = pieces.groupBy(F.spark_partition_id()).agg(F.sum(F.length("piece")).alias("n")).collect()
    assert len(tasks) >= 6 and max(r.n for r in tasks) < len(text) / 2
    assert pieces.agg(F.sum(F.length("piece"))).first()[0] == len(text)
    got = O.detect_in_pieces(df, ["doc_id"], piece_chars=1 << 16).select(F.size("findings")).first()[0]
    assert got == 5000


def test_pieces_of_texts_without_a_seam_and_with_astral_characters(spark):
    ts = ["7" * 300_000, "ab😀" * 100_000, "a,b;" * 1000, "😀\n" * 1000]
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id int, text string")
    got = {r.k: r for r in O.cut(df, ["doc_id"], "text", piece_chars=100).groupBy(F.col("__k0").alias("k")).agg(
        F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece"))), lambda p: p["piece"]), "").alias("t")).collect()}
    assert [got[i].t for i in range(4)] == ts and [got[i].n for i in range(3)] == [1, 1, 40]

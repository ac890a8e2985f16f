import zlib

import numpy as np
import pytest

from shroud.llm import common, token_output
from shroud.llm.queries import tokenizer_path
from shroud.llm.token_output import PieceEncoder

TEXTS = ["Hello, world. It's 3.14!", "", None, "a,b .c , d.\n", "J\u030C. É, e\u0301. I\u0307 \u0130x.", "x" * 300 + ".",
         "<|endoftext|> <|ENDOFTEXT|> we'll,", "tab\tnbsp\u00a0\u0085\u2028 end. ", "wörter, straße. \U0001F600.", "DON'T. 'S, (a). b).,",
         "\x1c\x1f a.\x1d", "日本語、テスト。 ok.", "a.. b,, c.,", "é, ×, ÷. à... ü!?) ñ*** a', x's. \"q\", ß;", "d'. l', —, é—. 5, x5.", "word, " * 3000, "Hello, world. It's 3.14!"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 2]


def test_pieces_equal_whole_texts(whole):
    enc = PieceEncoder(open(tokenizer_path(), encoding="utf-8").read())
    for t, ids in zip(TEXTS, enc.encode(TEXTS), strict=True):
        assert [*ids.tolist(), 2] == whole(t), t
    token_output.MEMO_PIECES, old = 2, token_output.MEMO_PIECES  # a full table is emptied, not wrong
    try:
        for t in TEXTS:
            assert [*enc.encode([t])[0].tolist(), 2] == whole(t)
    finally:
        token_output.MEMO_PIECES = old


def test_words_of_letters_equal_whole_texts(whole):
    import random
    rnd = random.Random(1)
    enc = PieceEncoder(open(tokenizer_path(), encoding="utf-8").read())
    assert len(enc.spelling) == 26 + 32
    texts = [" ".join("".join(rnd.choice("aeioutrsn" + "".join(map(chr, enc.spelling))) for _ in range(rnd.randint(1, 14))) for _ in range(50))
             for _ in range(60)] + [" ".join(map(chr, range(0xC0, 0x100))), "\u01f0x \u1e9e \u0131 \u017f \ufb01 ª º µ ŉ"]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert [*ids.tolist(), 2] == whole(t), t


def test_frequent_pieces_stay_when_the_table_is_full(monkeypatch):
    from collections import Counter
    monkeypatch.setattr(token_output, "MEMO_PIECES", 100)
    enc = PieceEncoder(open(tokenizer_path(), encoding="utf-8").read())
    coded, encode_new = Counter(), enc._encode_new
    monkeypatch.setattr(enc, "_encode_new", lambda pieces: (coded.update(pieces), encode_new(pieces))[1])
    often = [f"frequent-long-word-{c}" for c in "abcdefghij"]
    for i in range(30):
        enc.encode([" ".join([*often, *(f"x{i}y{j}" for j in range(20))])])
    assert {coded[w.encode()] for w in often} == {1} and len(coded) == 10 + 30 * 20


def test_punctuation_of_random_texts_equals_whole_texts(whole):
    import random
    rnd = random.Random(2)
    enc = PieceEncoder(open(tokenizer_path(), encoding="utf-8").read())
    texts = ["".join(rnd.choices(list("abzAZ09 .,;'\"-([{<|>~`^_\t\n\r\x0b\x85é×÷ßÀ\u0301日 \n "), k=rnd.randint(0, 40))) for _ in range(3000)]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert [*ids.tolist(), 2] == whole(t), t


def test_round_trip_offsets_and_checksums(spark, make, whole):
    rows = [(i * 7 % 31, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", None, None, None), (5, "same id", "", "", 0), (5, "same id", "", "", 0)]
    path = token_output.write_tokens(make(rows).withColumn("ids", common.F.lit("clash")), common.scratch(spark, "t"),
                                     tokenizer_path=tokenizer_path(), shards=4)
    got = sorted(token_output.token_digest(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    want = sorted((len(whole(r[1])), zlib.crc32(np.array(whole(r[1]), "<u4").tobytes())) for r in rows)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
    one = token_output.read_tokens(spark, path, columns=["n_tokens", "ids"], doc_ids=[7]).collect()
    assert one[0].ids == whole(TEXTS[1])
    plan = token_output.read_tokens(spark, path, columns=["n_tokens"], doc_ids=[7])._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "ids" not in plan.split("ReadSchema")[1]


def test_file_encodings(spark, make):
    import glob

    import pyarrow.parquet as pq
    path = token_output.write_tokens(make([(i, f"doc {i} " * 50, "", "", 0) for i in range(500)]), common.scratch(spark, "t"),
                                     tokenizer_path=tokenizer_path(), shards=2)
    meta = pq.ParquetFile(sorted(glob.glob(path.removeprefix("file:") + "/*.parquet"))[0]).metadata.row_group(0)
    enc = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert any("DELTA" in e for e in enc["doc_id"].encodings)
    assert any("DICTIONARY" in e for e in enc["ids.list.element"].encodings)
    assert enc["doc_id"].has_column_index and enc["ids.list.element"].has_offset_index


def test_empty(spark, make):
    path = token_output.write_tokens(make([]), common.scratch(spark, "t"), tokenizer_path=tokenizer_path())
    assert token_output.token_digest(spark, path).count() == 0

import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as P
from shroud.llm import common, toxicity
from shroud.llm.queries import ORACLE, tokenizer_path

from test_decontaminate import brute as contaminated
from test_simhash import fingerprint, groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after every stage, the first being the documents."""
    docs = common.table(spark, SF, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity(spark, stages):
    scorer = toxicity.Scorer(toxicity.fit(stages[0], common.table(spark, SF, "labels")))
    assert rows(stages[1]) == [r for r in rows(stages[0]) if scorer.score(r[1]) < 0.7]


def test_near_duplicates(stages):
    before = sorted(map(tuple, stages[1].collect()))
    g = groups([fingerprint(r[1]) for r in before])
    assert rows(stages[2]) == sorted((before[i] for i in set(g)), key=str)


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    bad = {r[0] for r in contaminated([(r[0], r[1]) for r in rows(stages[2])], items) if r[5]}
    assert bad and rows(stages[3]) == [r for r in rows(stages[2]) if r[0] not in bad]


def test_mixing(stages, tmp_path):
    stages[3].toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    taken = {r[0]: r[4] // r[1] if r[1] else 0 for r in con.sql(ORACLE["op2_mixing"]).fetchall()}
    assert rows(stages[4]) == sorted((r for r in rows(stages[3]) for _ in range(taken[r[0]])), key=str)


def test_tokens(stages):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    at = 0
    want = []
    for r in sorted(map(tuple, stages[4].collect())):
        ids = np.array([*tok.encode(r[1], add_special_tokens=False).ids, 2], "<u4")
        want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, stages[5].collect())) == want


def test_run_and_odd_rows(spark, stages, tmp_path):
    assert rows(P.run(spark, SF)) == rows(stages[5])
    odd = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "x"), (1, "", "en", "a", 0, "x"), (2, "w " * 30_000, None, None, 1, "x"),
         (3, "one two", "en", "b", 7, "x"), (3, "one two", "en", "b", 7, "x")],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, size string")
    for docs in (odd, odd.limit(0)):
        for name, stage in P.STAGES:
            new = stage(spark, docs, SF)
            if name != "token_output":
                assert new.columns == odd.columns
            new.write.parquet(path := str(tmp_path / f"{name}{docs.count()}{re.sub('[^0-9]', '', str(id(docs)))}"))
            docs = spark.read.parquet(path)

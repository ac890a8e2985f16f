"""Stored catalogue, data keys, rotation and encrypted download."""

import datetime
import os
import uuid

import pytest
from pyspark.sql import functions as F

from shroud.operators import datakeys as DK
from shroud.operators import protect as PR
from shroud.session import exists, scratch_path
from shroud.sources import catalogue as C

AT = datetime.datetime(2024, 1, 1)


def files(spark, n=200):
    rows = [(f"f{i}", "pdf", "local", f"local://{i}", f"{i}.txt", i, AT, None if i == 7 else f"text é😀 {i}") for i in range(n)]
    return spark.createDataFrame(rows, "file_id string, file_code string, source_kind string, uri string, name string, n_chars bigint, "
                                       "created_at timestamp, content string")


def masters(spark, *names):
    return spark.createDataFrame([(n, i, bytearray(os.urandom(32))) for i, n in enumerate(names)], PR.KEYS_SCHEMA)


@pytest.fixture()
def made(spark):
    root = scratch_path(spark, "store-test", uuid.uuid4().hex)
    m = masters(spark, "k1", "k2")
    path = f"{root}/masters"
    m.write.parquet(path)
    m = spark.read.parquet(path)
    f = files(spark)
    C.write_files(f, root, DK.create(f.select("file_id"), m, root), m)
    return root, m


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "file_id string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at(tokens, when=AT):
    return tokens.withColumn("requested_at", F.lit(when).cast("timestamp"))


def test_no_plain_text_and_listing_without_content(spark, made):
    root, _ = made
    table = C.stored(spark, root)
    assert "content" not in table.columns and table.where(F.col("content_enc").cast("string").contains("text")).count() == 0
    p = plan(C.list_files(spark, root))
    assert "content_enc" not in p and C.list_files(spark, root).count() == 200


def test_lookup_reaches_the_reader(spark, made):
    root, _ = made
    found = C.file_metadata(spark, root, ["f3", "f150", "nobody", None])
    p = plan(found)
    assert "PartitionFilters: [bucket" in p and "xxhash64" not in p and "PushedFilters: [In(file_id, [f150,f3,nobody])]" in p
    assert sorted(r.file_id for r in found.collect()) == ["f150", "f3"]
    assert sorted(r.file_id for r in C.file_metadata(spark, root, ids(spark, "f3", "f3", None, "x")).collect()) == ["f3"]
    assert C.file_metadata(spark, root, []).count() == 0


def test_delete_rewrites_only_touched_buckets(spark, made):
    root, m = made
    local = root.removeprefix("file://").removeprefix("file:")
    seen = lambda: {d: sorted(os.listdir(f"{local}/files/{d}")) for d in os.listdir(f"{local}/files") if d.startswith("bucket=")}
    before = seen()
    bucket = {r.file_id: r.bucket for r in C.stored(spark, root).select("file_id", "bucket").collect()}
    gone = ["f3", "f4", "missing", None] + [f for f, b in bucket.items() if b == bucket["f5"]]  # one bucket becomes empty
    touched = C.delete_files(spark, root, ids(spark, *gone))
    assert set(touched) == {bucket[f] for f in gone if f in bucket}
    after = seen()
    assert {d for d in before if before[d] != after.get(d)} == {f"bucket={b}" for b in touched} and f"bucket={bucket['f5']}" not in after
    assert {r.file_id for r in C.list_files(spark, root).collect()} == set(bucket) - set(gone)
    assert C.delete_files(spark, root, ids(spark, "missing")) == []
    keys = DK.data_keys(spark, root)
    got = DK.download(C.stored(spark, root), DK.check_requests(C.stored(spark, root), at(DK.issue_tokens(keys)), keys, m)).collect()
    assert {r.file_id for r in got if r.reason == "unknown file"} == {f for f in gone if f in bucket}


def test_a_killed_deletion_is_finished(spark, made):
    root, _ = made
    table = C.stored(spark, root)
    b = table.where("file_id = 'f3'").first()["bucket"]
    left = table.where((F.col("bucket") == b) & (F.col("file_id") != "f3"))
    left.write.parquet(f"{root}/staging/rows")
    assert C.list_files(spark, root).where("file_id = 'f3'").count() == 1  # incomplete: dropped
    assert not exists(spark, f"{root}/staging")
    left.write.parquet(f"{root}/staging/rows")
    spark.createDataFrame([(b,)], "bucket int").write.parquet(f"{root}/staging/touched")
    C.remove_path(spark, f"{root}/files/bucket={b}")  # killed between removing and replacing
    got = {r.file_id for r in C.list_files(spark, root).collect()}
    assert got == {f"f{i}" for i in range(200)} - {"f3"} and not exists(spark, f"{root}/staging")


def test_every_reason(spark, made):
    root, m = made
    keys, table = DK.data_keys(spark, root), C.stored(spark, root)
    token = {r.file_id: r.dek_token for r in DK.issue_tokens(keys).collect()}
    day = datetime.timedelta(days=1)
    rows = [("f1", token["f1"], AT + day), ("f2", token["f3"], AT), ("f4", "x" + token["f4"], AT), ("f5", token["f5"], AT + day + datetime.timedelta(seconds=1)),
            ("f6", token["f6"], AT - day), ("f8", token["f8"], None), ("f9", None, AT), ("nobody", token["f1"], AT), ("f10", "", AT), ("f7", token["f7"], AT),
            (None, token["f1"], AT)]
    req = spark.createDataFrame(rows, "file_id string, dek_token string, requested_at timestamp")
    checked = DK.check_requests(table, req, keys, m)
    assert checked.where(F.col("reason").isNotNull() & F.col("dek").isNotNull()).count() == 0
    got = {r.file_id: (r.content, r.reason) for r in DK.download(table, checked).collect()}
    assert got == {"f1": ("text é😀 1", None), "f2": (None, "bad token"), "f4": (None, "bad token"), "f5": (None, "expired"), "f6": (None, "not yet valid"),
                   "f8": (None, "no request time"), "f9": (None, "bad token"), "nobody": (None, "unknown file"), "f10": (None, "bad token"),
                   "f7": (None, "no content"), None: (None, "unknown file")}
    gone = DK.check_requests(table, at(DK.issue_tokens(keys)), keys, m.where("key_id = 'k1'"))
    assert {r.reason for r in gone.join(keys.select(F.col("file_id").alias("i"), "key_id"), F.col("i") == F.col("file_id")).where("key_id = 'k2'").collect()} == {"unknown key"}


def test_rotation_keeps_the_content(spark, made):
    root, m = made
    content = {r.file_id: bytes(r.content_enc) if r.content_enc else None for r in C.stored(spark, root).collect()}
    old = DK.issue_tokens(DK.data_keys(spark, root)).collect()
    old_tokens = at(spark.createDataFrame(old))
    deks = {r.file_id: bytes(r.dek) for r in DK.opened_keys(DK.data_keys(spark, root), m).collect()}
    both = m.unionByName(masters(spark, "k3"))
    path = f"{root}/masters3"
    both.write.parquet(path)
    both = spark.read.parquet(path)
    DK.rotate(spark, root, both, "k1", "k3")
    DK.rotate(spark, root, both, "k2", "k3")
    new_only = both.where("key_id = 'k3'")
    keys = DK.data_keys(spark, root)
    assert {r.key_id for r in keys.collect()} == {"k3"}
    assert {r.file_id: bytes(r.dek) for r in DK.opened_keys(keys, new_only).collect()} == deks and len(set(deks.values())) == 200
    table = C.stored(spark, root)
    assert {r.file_id: bytes(r.content_enc) if r.content_enc else None for r in table.collect()} == content
    got = DK.download(table, DK.check_requests(table, at(DK.issue_tokens(keys)), keys, new_only)).collect()
    assert {r.content for r in got if r.reason is None} == {f"text é😀 {i}" for i in range(200) if i != 7}
    assert {r.reason for r in DK.check_requests(table, old_tokens, keys, new_only).collect()} == {"old key version"}


def test_rotation_that_cannot_open_a_key_writes_nothing(spark, made):
    root, m = made
    for retire, to in (("k1", "k9"), ("k1", "k1")):
        with pytest.raises(ValueError):
            DK.rotate(spark, root, m, retire, to)
    wrong = masters(spark, "k1", "k3")
    path = f"{root}/wrong"
    wrong.write.parquet(path)
    with pytest.raises(Exception, match="data key does not open"):
        DK.rotate(spark, root, spark.read.parquet(path), "k1", "k3")
    assert {r.key_id for r in DK.data_keys(spark, root).collect()} == {"k1", "k2"}


def test_new_files_get_keys_and_old_ones_keep_theirs(spark, made):
    root, m = made
    before = {r.file_id: bytes(r.wrapped) for r in DK.data_keys(spark, root).collect()}
    DK.add(ids(spark, "f1", "g1", "g1", None), m, root)
    after = {r.file_id: bytes(r.wrapped) for r in DK.data_keys(spark, root).collect()}
    assert after.keys() - before.keys() == {"g1"} and all(after[f] == w for f, w in before.items())
    with pytest.raises(ValueError):
        DK.create(ids(spark, "z"), m, root)


def test_content_moved_to_another_id_does_not_open(spark, made):
    root, m = made
    keys, table = DK.data_keys(spark, root), C.stored(spark, root)
    checked = DK.check_requests(table, at(DK.issue_tokens(keys)), keys, m)
    moved = table.where("file_id = 'f1'").withColumn("file_id", F.lit("f2"))
    assert [r.reason for r in DK.download(moved, checked.where("file_id = 'f2'")).collect()] == ["no content"]
    p = plan(DK.download(table, checked))
    assert "0x" not in p and "X'" not in p  # no key in the plan


def test_content_moves_and_is_written_once(spark, made, tmp_path):
    root, m = made
    f = files(spark)
    f.write.parquet(str(tmp_path / "files"))
    src, keys = spark.read.parquet(str(tmp_path / "files")), DK.data_keys(spark, root)
    former = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with keys of many files
    try:
        p = plan(C._meet(src.select(*C.META, "content"), DK.opened_keys(keys, m).select("file_id", "dek"), "dek"))
    finally:
        for k, v in former.items():
            spark.conf.set(k, v)
    assert p.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in p and p.count("Sort [") == 1


def test_a_deletion_killed_between_two_buckets_is_finished(spark, made):
    root, _ = made
    table = C.stored(spark, root)
    bucket = {r.file_id: r.bucket for r in table.select("file_id", "bucket").collect()}
    a, b = bucket["f3"], next(x for x in bucket.values() if x != bucket["f3"])
    c = next(x for x in bucket.values() if x not in (a, b))
    gone = {"f3"} | {f for f, x in bucket.items() if x == c}
    left = table.where(F.col("bucket").isin(a, b) & (F.col("file_id") != "f3"))
    left.write.partitionBy("bucket").parquet(f"{root}/staging/rows")
    spark.createDataFrame([(a, True), (b, True), (c, False)], "bucket int, has_rows boolean").write.parquet(f"{root}/staging/touched")
    fs, staged = C._fs(spark, f"{root}/staging/rows/bucket={b}")
    C.remove_path(spark, f"{root}/files/bucket={b}")
    assert fs.rename(staged, C._fs(spark, f"{root}/files/bucket={b}")[1])  # b was moved, then the run was killed
    got = [r.file_id for r in C.list_files(spark, root).collect()]
    assert sorted(got) == sorted(set(bucket) - gone) and not exists(spark, f"{root}/staging")

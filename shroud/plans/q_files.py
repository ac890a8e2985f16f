"""Registered queries: files S1-S6, names F6/S8, protection P1-P3."""

from __future__ import annotations

from pyspark.sql import functions as F

from shroud.operators import protect as PR
from shroud.plans.registry import register
from shroud.sources import files as FS
from shroud.sources.tables import spread, table

INGESTED_AT = "2024-01-01 00:00:00"  # fixed ingestion time, so TTL results are repeatable
BAD_TOKEN_RULE = "n_chars % 7 = 0"      # derived requests: these present an altered token
DELAY_RULE = "n_chars % 2880"           # derived requests: minutes after ingestion


def _local_files(spark, sf_dir, keys=None):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars"), "doc_id")
    keys = keys if keys is not None else PR.load_or_create_keys(spark)
    return FS.ingest_local(docs, keys, F.lit(INGESTED_AT).cast("timestamp"))


def _url_files(spark, sf_dir, keys=None):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id")
    keys = keys if keys is not None else PR.load_or_create_keys(spark)
    return FS.ingest_url(pages, keys, F.lit(INGESTED_AT).cast("timestamp"))


def _tombstones(spark, sf_dir):
    """Files to delete, derived from the data: documents labelled quality 0."""
    return (table(spark, sf_dir, "labels").where(F.col("quality") == 0)
            .select(F.col("doc_id").cast("string").alias("file_id")))


_DOC_NAME = "source || '-' || CAST(doc_id AS VARCHAR) || '.txt'"
_URL_NAME = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]+$', 0)"
_LOCAL_SQL = (f"SELECT CAST(doc_id AS VARCHAR) AS file_id, 'local' AS source_kind, "
              f"'local://' || source || '/' || {_DOC_NAME} AS uri, {_DOC_NAME} AS name, "
              f"CAST(length(text) AS BIGINT) AS n_chars FROM documents")
_PAGES_SQL = None  # filled below (needs the HTML twin)


def _pages_sql():
    from shroud.plans.oracle import html_text
    return (f"SELECT 'p' || CAST(page_id AS VARCHAR) AS file_id, 'url' AS source_kind, url AS uri, "
            f"{_URL_NAME} AS name, CAST(length({html_text()}) AS BIGINT) AS n_chars, "
            f"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1) AS host FROM pages")


_PAGES_SQL = _pages_sql()
_ALL_META = (f"SELECT file_id, name, source_kind, n_chars FROM ({_LOCAL_SQL}) AS a UNION ALL "
             f"SELECT file_id, name, source_kind, n_chars FROM ({_PAGES_SQL}) AS b")
_DELETED = "(SELECT DISTINCT CAST(doc_id AS VARCHAR) AS file_id FROM labels WHERE quality = 0)"


@register("ingest_local", sql=_LOCAL_SQL)
def ingest_local(spark, sf_dir):
    return _local_files(spark, sf_dir).select("file_id", "source_kind", "uri", "name", "n_chars")


@register("ingest_url", sql=_PAGES_SQL)
def ingest_url(spark, sf_dir):
    return _url_files(spark, sf_dir).select("file_id", "source_kind", "uri", "name", "n_chars", "host")


def _all_files(spark, sf_dir):
    keys = PR.load_or_create_keys(spark)
    loc = _local_files(spark, sf_dir, keys).drop("host")
    url = _url_files(spark, sf_dir, keys).drop("host")
    return loc.unionByName(url)


@register("list_files", sql=_ALL_META)
def list_files(spark, sf_dir):
    return FS.list_files(_all_files(spark, sf_dir))


@register("file_metadata",
          sql=(f"SELECT * FROM ({_ALL_META}) AS m WHERE file_id IN "
               f"(SELECT CAST(doc_id AS VARCHAR) FROM labels)"))
def file_metadata(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("file_id"))
    return FS.file_metadata(_all_files(spark, sf_dir), ids)


@register("delete_files",
          sql=f"SELECT * FROM ({_ALL_META}) AS m WHERE file_id NOT IN (SELECT file_id FROM {_DELETED})")
def delete_files(spark, sf_dir):
    return FS.list_files(FS.delete_files(_all_files(spark, sf_dir), _tombstones(spark, sf_dir)))


def _download(spark, sf_dir):
    keys = PR.load_or_create_keys(spark)
    files = FS.delete_files(_local_files(spark, sf_dir, keys), _tombstones(spark, sf_dir))
    # requests for every document (deleted ones included), derived from the data
    fresh = _local_files(spark, sf_dir, keys).select("file_id", "dek_token", "n_chars")
    req = fresh.select(
        "file_id",
        F.when(F.expr(BAD_TOKEN_RULE), F.concat(F.lit("x"), F.col("dek_token")))
        .otherwise(F.col("dek_token")).alias("dek_token"),
        (F.lit(INGESTED_AT).cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.expr(DELAY_RULE).cast("int"))).alias("requested_at"))
    return FS.download(files, req, keys, ttl_minutes=1440)


_REQ = (f"SELECT CAST(doc_id AS VARCHAR) AS file_id, CAST(length(text) AS BIGINT) AS n_chars, "
        f"CAST(doc_id AS VARCHAR) IN (SELECT file_id FROM {_DELETED}) AS deleted FROM documents")
_REASON = (f"CASE WHEN deleted THEN 'unknown file' WHEN {BAD_TOKEN_RULE} THEN 'bad token' "
           f"WHEN {DELAY_RULE} > 1440 THEN 'expired' END")


@register("download_granted",
          sql=f"SELECT file_id, n_chars FROM ({_REQ}) AS r WHERE ({_REASON}) IS NULL")
def download_granted(spark, sf_dir):
    granted, _ = _download(spark, sf_dir)
    return granted.select("file_id", "n_chars")


@register("download_refused",
          sql=f"SELECT file_id, {_REASON} AS reason FROM ({_REQ}) AS r WHERE ({_REASON}) IS NOT NULL")
def download_refused(spark, sf_dir):
    _, refused = _download(spark, sf_dir)
    return refused


@register("redacted_names",
          sql=("SELECT file_id, regexp_replace(regexp_extract(name, '[^/]+$', 0), "
               "'^(.+?)(\\.[^.]*)?$', '\\1_redacted\\2') AS redacted_name "
               f"FROM ({_ALL_META}) AS m"))
def redacted_names(spark, sf_dir):
    files = FS.list_files(_all_files(spark, sf_dir))
    return files.select("file_id", FS.redacted_name(F.col("name")).alias("redacted_name"))


@register("protect_roundtrip", sql="SELECT doc_id, sha256(text) AS sha256 FROM documents")
def protect_roundtrip(spark, sf_dir):
    keys = PR.load_or_create_keys(spark)
    files = _local_files(spark, sf_dir, keys)
    opened = PR.unprotect(PR.protect(files, keys), files.select("file_id", "dek_token"), keys)
    return opened.select(F.col("file_id").cast("bigint").alias("doc_id"),
                         F.sha2(F.col("content"), 256).alias("sha256"))


@register("unprotect_refused",
          sql=("SELECT doc_id, 'moved content' AS reason FROM documents UNION ALL "
               f"SELECT doc_id, 'bad token' AS reason FROM documents WHERE length(text) % 7 = 0"))
def unprotect_refused(spark, sf_dir):
    """Own tokens (opened), altered tokens (bad token) and content moved to
    another id with a valid token for that id (refused by the AAD)."""
    keys = PR.load_or_create_keys(spark)
    files = _local_files(spark, sf_dir, keys)
    prot = PR.protect(files, keys)
    moved = prot.withColumn("file_id", F.concat(F.col("file_id"), F.lit("-copy")))
    moved_tokens = FS.with_master(moved.select("file_id", "key_id"), keys).select(
        "file_id", FS.wrap_token(F.col("master"), F.col("file_id")).alias("dek_token"))
    own = files.select("file_id", F.when(F.expr(BAD_TOKEN_RULE), F.concat(F.lit("x"), F.col("dek_token")))
                       .otherwise(F.col("dek_token")).alias("dek_token"))
    res = PR.unprotect(prot.unionByName(moved), own.unionByName(moved_tokens), keys)
    return res.where(F.col("reason").isNotNull()).select(
        F.regexp_replace(F.col("file_id"), F.lit("-copy$"), F.lit("")).cast("bigint").alias("doc_id"),
        "reason")


@register("token_valid_uses",
          sql=("SELECT arg_max(issue_id, (its, issue_id)) AS issue_id, use_id, user_id, "
               "CAST((epoch_us(uts) - epoch_us(max(its))) // 60000000 AS BIGINT) AS minutes FROM ("
               "SELECT i.event_id AS issue_id, i.ts AS its, u.event_id AS use_id, u.ts AS uts, i.user_id AS user_id "
               "FROM events AS i JOIN events AS u ON i.user_id = u.user_id AND u.ts >= i.ts "
               "AND u.ts <= i.ts + INTERVAL 1440 MINUTE "
               "WHERE i.event_type = 'signup' AND u.event_type = 'purchase') AS p GROUP BY use_id, user_id, uts"))
def token_valid_uses(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    issues = ev.where(F.col("event_type") == "signup")
    uses = ev.where(F.col("event_type") == "purchase")
    return PR.token_uses(issues, uses, ttl_minutes=1440)

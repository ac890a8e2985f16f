"""Files (M1): ingestion S1/S2, listing S3, lookup S4, download S5, delete S6.

A ``files`` row carries the text as ``content`` plus an access token
(``dek_token``): the file's data key wrapped under a master key, bound to the
file id.  Keys arrive as a column from a small key table joined on
``key_id``, never as literals (literals are printed in plans and logs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE_COLUMNS = ("file_id", "file_code", "source_kind", "uri", "name", "n_chars", "created_at",
                "content", "dek_token", "key_id")

# ---- fixed values: HTML entities decoded by ingest_url (&amp; is decoded last) ----
HTML_ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&commat;", "@"), ("&period;", "."), ("&lt;", "<"), ("&gt;", ">"),
                 ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
# ---- end of fixed values ----


_NUMERIC = r"&#(?:[xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});"


def decode_numeric(text: Column) -> Column:
    """Numeric character references (``&#64;``, ``&#x40;``) as their characters; a number
    that is no character (or a NUL) becomes U+FFFD, as browsers do."""
    found = F.regexp_extract_all(text, F.lit(_NUMERIC), F.lit(0))

    def one(m):
        body = F.substring(m, 3, 8)
        n = F.when(F.lower(F.substring(m, 3, 1)) == "x", F.conv(F.regexp_extract(body, "([0-9A-Fa-f]+);", 1), 16, 10)) \
            .otherwise(F.regexp_extract(body, "([0-9]+);", 1)).cast("long")
        ok = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(ok, n).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")

    pieces = F.split(text, F.lit(_NUMERIC), -1)
    joined = F.array_join(F.zip_with(pieces, F.transform(found, one), lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))), "")
    return F.when(F.size(found) > 0, joined).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags out, entities
    decoded (after the tags, so ``&lt;b&gt;`` stays text), blanks collapsed."""
    t = F.regexp_replace(html, F.lit(r"(?is)<script[^>]*>.*?</script[^>]*>"), F.lit(" "))
    t = F.regexp_replace(t, F.lit(r"(?is)<style[^>]*>.*?</style[^>]*>"), F.lit(" "))
    t = F.regexp_replace(t, F.lit(r"(?s)<!--.*?-->"), F.lit(" "))
    t = F.regexp_replace(t, F.lit(r"<[^>]*>"), F.lit(" "))
    t = decode_numeric(t)
    for ent, ch in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    t = F.regexp_replace(t, F.lit(r"[ \t\r\n]+"), F.lit(" "))
    return F.trim(t)


def derive_dek(master: Column, file_id: Column) -> Column:
    """Per-file 32-byte data key derived from the master key and the file id.

    Deterministic, so a recomputed task (lost executor) yields the same key."""
    return F.unhex(F.sha2(F.concat(F.hex(master), F.lit(":"), file_id), 256))


def _iv(file_id: Column, purpose: str) -> Column:
    # 12-byte GCM nonce, unique per (file, purpose); the wrapped plaintext is fixed per file
    return F.substring(F.unhex(F.sha2(F.concat(F.lit(purpose + ":"), file_id), 256)), 1, 12)


def wrap_token(master: Column, file_id: Column) -> Column:
    """``dekToken``: the data key encrypted under the master key, AAD = file id."""
    dek = derive_dek(master, file_id)
    return F.base64(F.aes_encrypt(dek, master, F.lit("GCM"), F.lit("DEFAULT"),
                                  _iv(file_id, "dek"), file_id.cast("binary")))


def unwrap_token(master: Column, file_id: Column, token: Column) -> Column:
    """The data key, or null for a wrong, altered or foreign token."""
    return F.try_aes_decrypt(F.try_to_binary(token, F.lit("base64")), master, F.lit("GCM"),
                             F.lit("DEFAULT"), file_id.cast("binary"))


def with_master(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Attach ``master`` by the file's ``key_id`` (a data column).  The key
    table holds one row per key version (a handful), checked before it is
    broadcast."""
    from shroud.operators.protect import checked_keys
    return df.join(F.broadcast(checked_keys(keys).drop("slot")), "key_id", "left")


def assign_keys(base: DataFrame, keys: DataFrame) -> DataFrame:
    """New files are spread over the key versions by a hash of the file id (an equi-join on
    the version's place, so gaps in the slots after a rotation lose no file), and
    keep their ``key_id`` for later unwrapping."""
    from shroud.operators.protect import checked_keys, key_count
    n = key_count(keys)
    place = F.row_number().over(Window.orderBy("slot", "key_id")) - 1  # at most MAX_KEYS rows
    placed = checked_keys(keys).withColumn("slot", place)
    slotted = base.withColumn("slot", F.pmod(F.xxhash64("file_id"), F.lit(n)).cast("int"))
    return slotted.join(F.broadcast(placed), "slot", "left").drop("slot")


def ingest_local(documents: DataFrame, keys: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Bring documents in as files, each with an id and a token."""
    created = created_at if created_at is not None else F.current_timestamp()
    name = F.concat(F.col("source"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(".txt"))
    base = documents.select(
        F.col("doc_id").cast("string").alias("file_id"), F.lit("pdf").alias("file_code"),
        F.lit("local").alias("source_kind"),
        F.concat(F.lit("local://"), F.col("source"), F.lit("/"), name).alias("uri"),
        name.alias("name"),
        # the stored length when the table has one: listing then never reads the text
        (F.col("n_chars") if "n_chars" in documents.columns else F.length("text")).cast("bigint").alias("n_chars"),
        created.cast("timestamp").alias("created_at"), F.col("text").alias("content"))
    return _tokenise(base, keys)


def ingest_text_files(spark, path: str, keys: DataFrame, created_at: Column | None = None) -> DataFrame:
    """S1 for files on disk: one row per whole file (``wholetext``), the file
    id derived from its path, the uri kept, the name its basename."""
    created = created_at if created_at is not None else F.current_timestamp()
    # the keyword, not .option(): text() re-applies its own wholetext=False default
    raw = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("uri"), F.col("value").alias("content"))
    base = raw.select(
        F.sha2(F.col("uri"), 256).substr(1, 32).alias("file_id"), F.lit("pdf").alias("file_code"),
        F.lit("local").alias("source_kind"), "uri",
        F.regexp_extract(F.col("uri"), r"[^/]+$", 0).alias("name"),
        F.length("content").cast("bigint").alias("n_chars"), created.cast("timestamp").alias("created_at"),
        "content")
    return _tokenise(base, keys)


def ingest_url(pages: DataFrame, keys: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Pages addressed by URL (already fetched); content is the visible text."""
    created = created_at if created_at is not None else F.current_timestamp()
    text = html_to_text(F.col("html"))
    base = pages.select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("file_id"),
        F.lit("pdf").alias("file_code"), F.lit("url").alias("source_kind"),
        F.col("url").alias("uri"), F.try_parse_url(F.col("url"), F.lit("HOST")).alias("host"),
        F.regexp_extract(F.regexp_replace(F.col("url"), F.lit(r"[?#].*$"), F.lit("")),
                         r"[^/]+$", 0).alias("name"),
        created.cast("timestamp").alias("created_at"), text.alias("content"))
    base = base.withColumn("n_chars", F.length("content").cast("bigint"))
    return _tokenise(base, keys)


def _tokenise(base: DataFrame, keys: DataFrame) -> DataFrame:
    joined = assign_keys(base, keys)
    return joined.select(*base.columns, "key_id", wrap_token(F.col("master"), F.col("file_id")).alias("dek_token"))


def list_files(files: DataFrame) -> DataFrame:
    """S3: metadata only; ``content`` is never read (column pruning)."""
    return files.select("file_id", "name", "source_kind", "n_chars")


def file_metadata(files: DataFrame, ids) -> DataFrame:
    """Metadata by ids, from a list (a filter) or a DataFrame (a semi join; Catalyst picks its kind).
    The ids of freshly ingested files are computed, so neither reaches the Parquet reader: a point
    lookup that does is the stored catalogue's (``sources.catalogue``)."""
    meta = list_files(files)
    if isinstance(ids, DataFrame):
        id_df = ids.select("file_id").distinct()
        return meta.join(id_df, "file_id", "left_semi")
    return meta.where(F.col("file_id").isin(list(ids)))


def delete_files(files: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Files minus the deleted ids (anti join on a tombstone table)."""
    return files.join(tombstones.select("file_id").distinct(), "file_id", "left_anti")


def download(files: DataFrame, requests: DataFrame, keys: DataFrame,
             ttl_minutes: int = 1440) -> tuple[DataFrame, DataFrame]:
    """Content only when (file_id, dek_token) match and the token is live.

    Returns (granted, refused).  ``requests``: file_id, dek_token, requested_at.
    The token is checked by unwrapping it with the master key (so a token made
    for another file does not open this one), not by comparing stored strings.
    """
    f = with_master(files.select("file_id", "key_id", "created_at", "content", "n_chars", F.lit(True).alias("_found")), keys)
    r = requests.select("file_id", F.col("dek_token").alias("req_token"), "requested_at")
    j = r.join(f, "file_id", "left")
    ok_token = unwrap_token(F.col("master"), F.col("file_id"), F.col("req_token")).isNotNull()
    ends = F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(ttl_minutes))
    # granted only when every test is true; a null time or token is a refusal
    reason = (F.when(F.col("_found").isNull(), F.lit("unknown file"))
              .when(F.col("master").isNull(), F.lit("unknown key"))
              .when(~F.coalesce(ok_token, F.lit(False)), F.lit("bad token"))
              .when(F.col("requested_at").isNull(), F.lit("no request time"))
              .when(~F.coalesce(F.col("requested_at") >= F.col("created_at"), F.lit(False)), F.lit("not yet valid"))
              .when(~F.coalesce(F.col("requested_at") <= ends, F.lit(False)), F.lit("expired")))
    checked = j.withColumn("reason", reason)
    granted = checked.where(F.col("reason").isNull()).select("file_id", "n_chars", "content")
    refused = checked.where(F.col("reason").isNotNull()).select("file_id", "reason")
    return granted, refused


def redacted_name(path: Column) -> Column:
    """basename, then ``_redacted`` before the last extension (kept)."""
    base = F.regexp_extract(path, r"[^/]+$", 0)
    return F.regexp_replace(base, F.lit(r"^(.+?)(\.[^.]*)?$"), F.lit("$1_redacted$2"))

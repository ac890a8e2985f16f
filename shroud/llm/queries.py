"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

END_ID = 2
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.settings(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return deco


def tokenizer_path() -> str:
    """Vocabulary file of the token output (a parameter of the operator)."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_mixing", r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(text), 'null')), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS wt,
             row_number() OVER (ORDER BY source NULLS LAST) AS i FROM s),
l AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / wt AS lvl, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM w),
r AS (SELECT *, budget - coalesce(sum(cap) OVER below, 0) AS lft, (sum(wt) OVER ()) - coalesce(sum(wt) OVER below, 0) AS wleft
      FROM l WINDOW below AS (ORDER BY lvl, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(lft, (lvl, i)) AS lft0, arg_min(wleft, (lvl, i)) AS w0 FROM r WHERE lft < lvl * wleft),
t AS (SELECT source, source_size, CASE WHEN lft < lvl * wleft THEN lft0 * wt / w0 ELSE cap END AS target FROM r LEFT JOIN f ON TRUE),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, target - whole * source_size AS rest, CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS p0 FROM p),
k AS (SELECT d.doc_id, d.size, q.source, q.source_size, q.target, q.whole, q.rest,
             (d.u / (1 - d.u)) / (least(greatest(p0, 1e-12), 1 - 1e-12) / (1 - least(greatest(p0, 1e-12), 1 - 1e-12))) AS odds
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, odds / (1 + odds) AS rk,
             sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY source, odds / (1 + odds), size) AS tied FROM k)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND upto - tied / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c""")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing
    docs = common.table(spark, sf_dir, "documents")
    return mixing.mix(docs, weights=(3, 1, 2), budget=1.5, cap=2.0).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op8_token_output")
def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_output
    path = token_output.write_tokens(common.table(spark, sf_dir, "documents"), common.scratch(spark, "tokens"),
                                     tokenizer_path=tokenizer_path(), end_id=END_ID)
    return token_output.token_digest(spark, path)


@query("op10_url_filter", r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import url_filter
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.url_filter(pages, URL_RULES).drop("url")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op3_decontamination", r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hit AS (SELECT p.r, p.i, p.n, win.item_id FROM (SELECT r, i, n, list_slice(w, i, i + n - 1) AS g FROM pos) p JOIN win ON win.n = p.n AND win.g = p.g),
cov AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM hit) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN it USING (r)""")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate as D
    index = D.build_index(common.table(spark, sf_dir, "documents"))
    hits = D.phrase_hits(index, common.table(spark, sf_dir, "benchmark"))
    return D.contamination(hits).withColumnRenamed("__id", "doc_id").drop("__th")


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_dedup
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op7_topk", r"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM p) WHERE rank <= 5""")
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import topk
    return topk.top_k(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


#: So many ids of labelled good documents (8 bytes each) are broadcast; more are met by a shuffle.
BROADCAST_IDS = 1_000_000


@query("op9_resample")
def op9_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many documents as the labels' share of good ones; the target model is counted from all labelled good texts."""
    from . import resample
    labels = common.table(spark, sf_dir, "labels").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    n = labels.agg(F.count("*").alias("n"), F.count(F.when(F.col("quality") == 1, 1)).alias("good")).first()
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("good_id")).distinct()
    if n["good"] <= BROADCAST_IDS:
        good = F.broadcast(good)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.join(good, F.col("doc_id") == F.col("good_id"), "left")
    return resample.resample(docs, F.col("good_id").isNotNull(), share=n["good"] / n["n"] if n["n"] else 1.0).select(
        "doc_id", "log_weight", "gumbel_key", "selected")


@query("op4_line_dedup", r"""
WITH l AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS n, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
f AS (SELECT doc_id, n, line, length(line) AS m, dense_rank() OVER (ORDER BY doc_id NULLS LAST, n) AS pos FROM l WHERE trim(translate(line, chr(9) || chr(13), '  ')) <> ''),
u AS (SELECT line, any_value(m) AS m, min(pos) AS pos FROM f GROUP BY line),
k AS (SELECT line, m, pos, c, unnest([0, 1]) AS side FROM (SELECT line, m, pos, unnest([m, m - 1]) AS c FROM u WHERE m >= 20)),
h AS (SELECT *, CASE side WHEN 0 THEN left(line, c // 2) ELSE right(line, c - c // 2) END AS part FROM k),
near AS (SELECT DISTINCT a.line FROM h a JOIN h b ON a.c = b.c AND a.side = b.side AND a.part = b.part AND b.pos < a.pos WHERE levenshtein(a.line, b.line) <= 1),
d AS (SELECT f.doc_id, f.n FROM f JOIN u USING (line) WHERE f.pos > u.pos OR f.line IN (SELECT line FROM near)),
g AS (SELECT doc_id, count(*)::BIGINT AS n_dropped, list(n::INTEGER ORDER BY n) AS dropped FROM d GROUP BY doc_id)
SELECT documents.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(dropped, []::INTEGER[]) AS dropped
FROM documents LEFT JOIN g ON documents.doc_id IS NOT DISTINCT FROM g.doc_id""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_dedup
    return line_dedup.line_report(common.table(spark, sf_dir, "documents"))


@query("op11_fingerprint")
def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import imatch
    return imatch.fingerprint_pairs(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_filter_audit", r"""
WITH l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
             [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t),
              regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS x
      FROM d LEFT JOIN l USING (doc_id)),
cell AS (SELECT part, x, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, x),
s AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM s a, s b, s c, s d, s e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
st AS (SELECT p, i AS step, p[i] AS flt, p[:i - 1] AS before FROM o, s),
m AS (SELECT part, p, step, flt, n, good, toxic, x[flt] AS hits, len(list_filter(before, lambda y: x[y])) > 0 AS gone,
             len(list_filter(x, lambda y: y)) = 1 AS lone FROM cell, st),
r AS (SELECT part, p, step, flt, sum(n) FILTER (NOT gone AND NOT hits) AS kept, sum(n) FILTER (NOT gone AND hits) AS removed,
             sum(n) FILTER (gone AND hits) AS redundant, sum(n) FILTER (hits AND lone) AS unique_fails,
             sum(good) FILTER (NOT gone AND hits) AS good_lost, sum(toxic) FILTER (NOT gone AND hits) AS toxic_lost FROM m GROUP BY part, p, step, flt)
SELECT part, array_to_string(list_transform(p, lambda y: substr('ABCDE', y, 1)), '') AS filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, flt))::BIGINT AS shapley
FROM r""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import filter_audit
    return filter_audit.audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@query("op13_lexical_search", r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
q AS (SELECT item_id, t, count(*)::BIGINT AS reps FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, r, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, r, len(w)::BIGINT AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY t, n_docs),
i AS (SELECT doc_id, r, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)) AS impact FROM p, c),
s AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(reps * w * impact)::BIGINT AS score FROM q JOIN w USING (t) JOIN i USING (t) GROUP BY item_id, r)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM s WHERE score > 0) WHERE rank <= 20""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lexical_search as L
    index, n_docs, _ = L.build_index(common.table(spark, sf_dir, "documents"))
    return L.search(index, n_docs, common.table(spark, sf_dir, "benchmark"), k=20)

"""Exact top-k inner products with norm-bucketed retrieval.

Vectors are grouped by length (norm): buckets of geometrically falling length, cut
into chunks of at most ``CHUNK`` vectors, so that a length shared by many rows fills
several chunks.  Chunks and blocks of queries are packed rows (one matrix each), dealt to groups
of bounded bytes; a cell of the grid is a group of chunks and a group of blocks, and is the unit of work.
Which cells meet is decided on narrow rows; a matrix is sent once per cell.

Inside a chunk, with the local threshold t of a query (its k-th best score so far):

* *length pruning*: |q| x |longest vector| < t rejects the chunk for that query; and
  vectors are sorted by length, so only a prefix with |q| x |v| >= t can matter;
* the local cosine threshold is t / (|q| x longest).  When it is high, *coordinate
  pruning* pays: for the query's largest coordinate c, a unit vector with cosine >= s
  has its coordinate in [q_c s - r, q_c s + r], r = sqrt((1 - q_c^2)(1 - s^2)); only
  vectors whose normalised coordinate lies there remain.  Otherwise length pruning alone is used.

Remaining vectors are verified by integer products.  A first threshold comes from
the chunk of longest vectors, which every query block sees first: the k-th best score there
is a lower bound of the k-th best of all; inside a cell it rises with every chunk.  A cell gives at most k rows per query.

Defined results: scores are integer products of floor(``SCALE`` * x); ties go to the
smaller id; a query row is never its own candidate; vectors that are null, empty of
numbers (null or non-finite components) or have a null id take no part; rows with a
repeated id take part as they come; queries of another dimension than a candidate don't meet it; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SCALE = 256
#: Vectors to a chunk, queries to a block, blocks that meet a chunk in one task.
CHUNK, QUERY_BLOCK, GROUP = 8192, 1024, 32
PACK = "pack bigint, dim int, top double, kind string, ids binary, uids binary, flat binary"
#: Buckets of lengths per factor of two.
STEPS = 4
#: Bytes of packed vectors that a cell of the grid holds of each side, about; parts of the join of the cells' narrow keys.
CELL_BYTES, SALTS = 8 << 20, 16
#: Local cosine threshold from which coordinate pruning is used.
COORDINATE_FROM = 0.5


def quantized(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(uid, id, v, norm, dim)``: usable vectors as integer components and their squared length."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (df.filter(F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & F.coalesce(usable, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))
            .withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
            .withColumn("dim", F.size("v")))
    # row numbers of a stored table: the same on every retry
    return common.materialize(rows, "vectors").withColumn("uid", F.monotonically_increasing_id())


def _pack(rows: DataFrame, bucket, limit: int) -> DataFrame:
    """Groups of about ``limit`` vectors of one dimension and ``bucket``, one row each:
    ``pack, dim, top`` (largest length) and the matrix (longest first)."""
    rows = rows.withColumn("bucket", bucket)
    sizes = rows.groupBy("dim", "bucket").agg(F.count("*").alias("size")).withColumnsRenamed({"dim": "_d", "bucket": "_b"})
    rows = rows.join(sizes, (F.col("dim") == F.col("_d")) & (F.col("bucket") == F.col("_b"))) \
        .withColumn("part", F.pmod(F.xxhash64("uid"), F.ceil(F.col("size") / limit)))

    def run(table: pa.Table) -> pa.Table:
        norm = table.column("norm").to_numpy()
        order = np.lexsort((table.column("id").to_numpy(), -norm))
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(norm), -1)[order]
        top = int(np.abs(flat).max())
        kind = next(k for k in ("<i2", "<i4", "<i8") if top <= np.iinfo(k).max)
        pick = lambda c: table.column(c).to_numpy()[order].astype("<i8").tobytes()
        return pa.table({"pack": table.column("uid").take(pa.array([order[0]])), "dim": pa.array([flat.shape[1]], pa.int32()),
                         "top": [float(np.sqrt(norm.max()))], "kind": [kind], "ids": [pick("id")], "uids": [pick("uid")],
                         "flat": [flat.astype(kind).tobytes()]})

    return rows.groupBy("dim", "bucket", "part").applyInArrow(run, PACK)


class Pack:
    def __init__(self, table: pa.Table, i: int):
        get = lambda c: table.column(c)[i].as_py()
        self.pack, self.top = get("pack"), get("top")
        self.ids, self.uids = (np.frombuffer(get(c), "<i8") for c in ("ids", "uids"))
        self.ints = np.frombuffer(get("flat"), get("kind")).reshape(len(self.ids), -1)
        self.floats = self.ints.astype(np.float64)
        self.norms = np.sqrt((self.floats ** 2).sum(1))
        self.theta = np.frombuffer(get("theta"), "<f8") if "theta" in table.column_names else np.full(len(self.ids), -np.inf)


def _products(a: "Pack", rows, q: "Pack", j) -> np.ndarray:
    """Exact products of vectors ``rows`` of a with query (or queries) ``j`` of q."""
    if a.top * q.top < 2.0 ** 52:  # every partial sum is exact in a double
        return (a.floats[rows] @ q.floats[j].T).astype(np.int64)
    return a.ints[rows].astype(np.int64) @ q.ints[j].astype(np.int64).T


def search(a: Pack, q: Pack, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, vectors, scores): up to k best vectors of the chunk per query that can reach its threshold."""
    slack = 1 - 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(q.theta > 0, q.theta * slack / np.maximum(q.norms, 1e-300), -1.0)
    reach = np.searchsorted(-a.norms, -need, side="right")  # length pruning: a prefix of the chunk
    local = need / max(a.top, 1e-300)
    unit = None
    whole = np.flatnonzero((reach > 0) & (local < COORDINATE_FROM))
    for at in range(0, len(whole), 64):
        part = whole[at:at + 64]
        scores = _products(a, slice(0, int(reach[part].max())), q, part)
        for col, j in enumerate(part):
            yield _best(a, q, j, np.arange(reach[j]), scores[:reach[j], col], k)
    for j in np.flatnonzero((reach > 0) & (local >= COORDINATE_FROM)):
        if unit is None:
            unit = a.floats / np.maximum(a.norms, 1e-300)[:, None]
        direction = q.floats[j] / q.norms[j]
        f = int(np.argmax(np.abs(direction)))
        c, s = direction[f], min(1.0, local[j])
        width = np.sqrt(max(0.0, (1 - c * c) * (1 - s * s)))
        low = -1.0 if c <= -s else c * s - width  # past the pole the bound is the pole
        high = 1.0 if c >= s else c * s + width
        u = unit[:reach[j], f]
        rows = np.flatnonzero((u >= low - 1e-9) & (u <= high + 1e-9))
        if len(rows):
            yield _best(a, q, j, rows, _products(a, rows, q, j), k)


def _best(a: Pack, q: Pack, j: int, rows: np.ndarray, scores: np.ndarray, k: int):
    ok = (scores >= q.theta[j]) & (a.uids[rows] != q.uids[j])
    rows, scores = rows[ok], scores[ok]
    if len(rows) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[scores >= edge], scores[scores >= edge]
    order = np.lexsort((a.ids[rows], -scores))[:k]
    return int(j), rows[order], scores[order]


def _meet(chunks: DataFrame, pairs: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work(chunk, block)`` for all pairs (blocks with a ``chunk`` column).  A task holds
    one chunk and at most about ``GROUP`` blocks; a chunk with more blocks is sent again."""
    n = pairs.groupBy("chunk").agg(F.ceil(F.count("*") / GROUP).alias("_n")).withColumnRenamed("chunk", "_c")
    right = pairs.join(n, F.col("chunk") == F.col("_c")).withColumn("_g", F.pmod(F.xxhash64("pack"), F.col("_n"))).drop("_c", "_n")
    left = (chunks.join(n, F.col("pack") == F.col("_c"))
            .withColumn("_g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
            .withColumnRenamed("_c", "chunk").drop("_n"))

    def run(chunk: pa.Table, blocks: pa.Table) -> pa.Table:
        parts = []
        if chunk.num_rows:
            a = Pack(chunk, 0)
            parts = [work(a, Pack(blocks, i), blocks.slice(i, 1)) for i in range(blocks.num_rows)]
        return pa.concat_tables(parts) if parts else work(None, None, blocks.slice(0, 0))

    return left.groupBy("chunk", "_g").cogroup(right.groupBy("chunk", "_g")).applyInArrow(run, schema)


def _thresholds(k: int):
    """The block again, with each query's k-th best score so far and the least length that can reach any."""
    names = [f.split()[0] for f in PACK.split(", ")]

    def work(a, q, block: pa.Table) -> pa.Table:
        theta, need = [], []
        if q is not None:
            t = np.full(len(q.ids), -np.inf)
            for j, _, scores in search(a, q, k):
                if len(scores) == k:
                    t[j] = scores[-1]
            theta.append(t.astype("<f8").tobytes())
            need.append(float(np.where(t > 0, t * (1 - 1e-9) / np.maximum(q.norms, 1e-300), -1.0).min()))
        out = block.select(names)
        return out.append_column("theta", pa.array(theta, pa.binary())).append_column("need", pa.array(need, pa.float64()))
    return work


def _cells(df: DataFrame, size: str, group: str) -> DataFrame:
    """Rows dealt to groups of like ``size`` (the first part of the group's key) of about ``CELL_BYTES`` of matrices."""
    level = F.floor(F.log2(F.greatest(F.col(size), F.lit(0.0)) + 1) * STEPS).cast("int").alias("_lv")
    n = df.groupBy("dim", level).agg(F.ceil(F.sum(F.length("flat")) / CELL_BYTES).alias("_n")).select(F.col("dim").alias("_nd"), F.col("_lv").alias("_nl"), "_n")
    rows = df.withColumn("_lv", level)
    return (rows.join(n, (F.col("dim") == F.col("_nd")) & (F.col("_lv") == F.col("_nl")))
            .withColumn(group, F.struct("dim", "_lv", F.pmod(F.xxhash64("pack"), F.greatest("_n", F.lit(1))).alias("part"))).drop("_nd", "_nl", "_lv", "_n"))


def _grid(chunks: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The k best per query of every cell.  A cell is a group of chunks and a group of query blocks whose
    lengths and thresholds let them meet; matrices are sent once per cell, not once per pair of them."""
    left = _cells(chunks, "top", "cg")
    right = _cells(blocks, "need", "bg")
    tops = left.groupBy("cg").agg(F.max("top").alias("_t")).withColumn("_s", F.pmod(F.xxhash64("cg"), F.lit(SALTS)))
    needs = right.groupBy("bg").agg(F.min("need").alias("_need")).withColumn("_bs", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    cells = tops.join(needs, (F.col("cg.dim") == F.col("bg.dim")) & (F.col("_s") == F.col("_bs")) & (F.col("_t") >= F.col("_need"))).select(
        F.col("cg").alias("_cg"), F.col("bg").alias("_bg"))
    chunk_rows = left.join(cells, F.col("cg") == F.col("_cg")).select(F.to_json("_cg").alias("c"), F.to_json("_bg").alias("b"), *chunks.columns)
    block_rows = right.join(cells, F.col("bg") == F.col("_bg")).select(F.to_json("_cg").alias("c"), F.to_json("_bg").alias("b"), *blocks.columns)

    def run(chunk_table: pa.Table, block_table: pa.Table) -> pa.Table:
        packs = sorted((Pack(chunk_table, i) for i in range(chunk_table.num_rows)), key=lambda a: -a.top)
        parts = [_block_best(packs, Pack(block_table, i), block_table.column("need")[i].as_py(), k) for i in range(block_table.num_rows)]
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 5
        return pa.table(dict(zip(("query_id", "uid", "vec_id", "vec_uid", "score"), cols, strict=True)))

    return chunk_rows.groupBy("c", "b").cogroup(block_rows.groupBy("c", "b")).applyInArrow(
        run, "query_id bigint, uid bigint, vec_id bigint, vec_uid bigint, score bigint")


def _block_best(packs: list["Pack"], q: "Pack", need: float, k: int) -> tuple[np.ndarray, ...]:
    """The k best of a cell's chunks per query, longest chunks first; a k-th best score found raises the query's threshold."""
    q.theta = q.theta.copy()
    found: list[tuple] = [(np.empty(0, np.int64),) * 4]
    for a in packs:
        if a.top < need:
            break
        better = []
        for j, rows, scores in search(a, q, k):
            found.append((np.full(len(rows), j), a.ids[rows], a.uids[rows], scores))
            if len(scores) == k and scores[-1] > q.theta[j]:
                better.append((j, scores[-1]))
        for j, score in better:
            q.theta[j] = score
    j, ids, uids, scores = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
    order = np.lexsort((uids, ids, -scores, j))
    j, ids, uids, scores = j[order], ids[order], uids[order], scores[order]
    first = np.searchsorted(j, j, side="left")
    keep = np.arange(len(j)) - first < k
    return q.ids[j[keep]], q.uids[j[keep]], ids[keep], uids[keep], scores[keep]


def top_k(df: DataFrame, is_query: Column, *, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest products of every query row."""
    rows = quantized(df, id_col, vec_col)
    queries = rows.withColumnRenamed("id", id_col).withColumn("__query", is_query).filter("__query") \
        .drop("__query").withColumnRenamed(id_col, "id")
    chunks = common.materialize(_pack(rows, F.floor(F.log2(F.col("norm") + 1) * STEPS / 2), CHUNK), "chunks")
    blocks = common.materialize(_pack(queries, F.lit(0).cast("long"), QUERY_BLOCK), "queries")

    # first thresholds, from the chunk of longest vectors of each dimension
    first = chunks.groupBy("dim").agg(F.max(F.struct("top", "pack")).alias("m")).select(F.col("m.pack").alias("chunk"), F.col("dim").alias("_d"))
    pairs = blocks.join(first, F.col("dim") == F.col("_d")).drop("_d")
    blocks = common.materialize(_meet(chunks, pairs, _thresholds(k), PACK + ", theta binary, need double"), "thresholds")

    found = _grid(chunks, blocks, k)
    best = Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id", "vec_uid")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

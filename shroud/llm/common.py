"""Shared pieces of the corpus operators.

Conventions every operator follows
----------------------------------
* Operators take a DataFrame plus the names of its key and text columns and
  first project those under reserved names, so extra columns (also ones whose
  names clash with an operator's own) never reach a join.
* A text's rows are matched back by ``(id, hash of the text)``, null-safely.
  Null ids, null texts and repeated rows therefore keep one row each.
* Tables that several jobs read again are written once below the folder named
  by ``spark.checkpoint.dir`` (never to a machine-local folder on a cluster).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.session import checkpoint_root, ensure_settings

#: Bytes of text handled at once inside one Python task; a batch of documents is
#: cut so that the numpy work arrays (some 60 bytes per byte) stay below 64 MB.
BLOCK_BYTES = 1 << 20


#: Rows of an Arrow batch.  Texts have a few kB, so the default of 10,000 rows would hold
#: tens of MB of text several times over in every Python worker.
ARROW_ROWS = 1_000
#: Bytes of an Arrow batch: long texts (or rows of an index) come in fewer rows.
ARROW_BYTES = 4 << 20


#: Rows of a row group of a table whose rows have some MB each.
GROUP_ROWS = 4


def settings(spark: SparkSession) -> None:
    ensure_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def tidy() -> None:
    """Give memory that nothing uses back to the system.

    Python workers serve one stage after another; what a stage freed stays with the
    allocators of Python, Arrow and C otherwise, and adds up over the stages."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidied(run):
    """``run`` (an iterator to an iterator, in a Python worker) that begins and ends with :func:`tidy`."""
    @functools.wraps(run)
    def tidy_run(*args, **kw):
        tidy()
        yield from run(*args, **kw)
        tidy()
    return tidy_run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{checkpoint_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, and a
    lost executor costs a re-read instead of a recomputation."""
    path = scratch(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def materialize_wide(df: DataFrame, label: str, **options: str) -> DataFrame:
    """:func:`materialize` for rows of some MB each.

    Spark's Parquet reader takes up to 4,096 rows of a row group at once, whatever their bytes, and its writer
    measures a row group by its encoded bytes: a task's whole share could lie in memory. Here a row group has
    ``GROUP_ROWS`` rows."""
    path = scratch(df.sparkSession, label)
    schema = df.schema
    df.write.option("parquet.block.row.count.limit", str(GROUP_ROWS)).options(**options).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def remove(df_or_path, spark: SparkSession) -> None:
    """Delete scratch tables made by :func:`materialize` (safe when absent)."""
    paths = [df_or_path] if isinstance(df_or_path, str) else df_or_path.inputFiles()[:1]
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if not isinstance(df_or_path, str):
            path = path.getParent()
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, True)


def text_hash(text: Column) -> Column:
    """64-bit content hash; a null text has its own value."""
    return F.xxhash64(F.coalesce(text, F.lit("\u0000null")))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(__id, __th, __text)``: key, content hash and text of every row."""
    return df.select(F.col(id_col).alias("__id"), text_hash(F.col(text_col)).alias("__th"),
                     F.col(text_col).alias("__text"))


def join_flags(df: DataFrame, flags: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """Join ``flags(__id, __th, ...)`` (at most one row per key) back to the rows of ``df``."""
    left = df.withColumn("__jid", F.col(id_col)).withColumn("__jth", text_hash(F.col(text_col)))
    out = left.join(flags, F.col("__jid").eqNullSafe(F.col("__id")) & (F.col("__jth") == F.col("__th")), how)
    return out.drop("__jid", "__jth", "__id", "__th")


def blocks(items: list, size_of, limit: int = BLOCK_BYTES):
    """Cut a list into runs of at most ``limit`` bytes (a larger item stands alone)."""
    run, total = [], 0
    for x in items:
        n = size_of(x)
        if run and total + n > limit:
            yield run
            run, total = [], 0
        run.append(x)
        total += n
    if run:
        yield run

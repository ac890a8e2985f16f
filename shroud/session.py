"""Session helper: the settings every shroud job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings shroud needs for correct results (UTC timestamps) and for good plans
# at scale (AQE re-planning, skew splitting, partition coalescing).
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a batch of texts on its way to Python: by default 10,000 rows, however long
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # keys are joined columns, never literals; as a second guard, any long hex
    # or binary literal (the shape of a key) is masked in plan strings and logs
    "spark.sql.redaction.string.regex": "(?i)(0x[0-9a-f]{32,}|X'[0-9a-f]{32,}')",
}


def get_session(app: str = "shroud", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = (builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
                       .config("spark.ui.showConsoleProgress", "false"))
    for k, v in _REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _REQUIRED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def ensure_settings(spark: SparkSession) -> None:
    """Apply the settings shroud's results and plans rely on to a session
    someone else built (idempotent, runtime-settable options only), and make
    the package importable by the Python workers."""
    for k, v in _REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_root(spark)
    ship_package(spark)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Python steps (NER's ``mapInPandas``, the job tracker's state function)
    run in executor Python workers, which must import ``shroud``.  The package
    is zipped once per application and distributed with ``addPyFile``."""
    import os
    import tempfile
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="shroud-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _dirs, files in os.walk(root):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.join("shroud", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.  Only
    when it is unset (local tests) a fresh folder is created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            # executors and driver share no local folder on a cluster
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="shroud-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (never machine-local on a cluster)."""
    return "/".join([checkpoint_root(spark), *parts])


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


__all__ = ["get_session", "checkpoint_root", "scratch_path", "exists", "is_local_path"]

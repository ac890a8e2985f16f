"""Name -> (Spark query, DuckDB oracle SQL) registry behind ``__spark_entry__``."""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``.  The registered callable
    first applies the session settings results depend on (UTC time zone: the
    event times are wall-clock values), whatever session the caller built."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            from shroud.session import ensure_settings
            ensure_settings(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


MODULES = ("q_detect", "q_files", "q_jobs", "q_keywords", "q_review", "q_workflow", "q_streams", "q_store", "q_learned")


def load_all() -> None:
    """Importing the query modules fills the registry."""
    import importlib
    for m in MODULES:
        importlib.import_module(f"shroud.plans.{m}")

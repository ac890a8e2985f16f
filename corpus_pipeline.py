"""Corpus pipeline: documents to token ids, in five stages.

Every stage is one operator of ``shroud.llm`` at its production parameters.  A stage
reads all rows that its predecessor kept (written as Parquet in between) and returns
the columns of ``documents``; the last returns one row per document of the token files.

Nulls, repeated rows and empty tables take the results that the operators define.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from shroud.llm import common, decontaminate, mixing, simhash, token_output, toxicity
from shroud.llm.queries import END_ID, tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.take(docs, weights=(3, 1, 2), budget=1.5, cap=2.0)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document of them ``doc_id, start, n_tokens, ids_crc32``."""
    path = token_output.write_tokens(docs, common.scratch(spark, "tokens"), tokenizer_path=tokenizer_path(), end_id=END_ID)
    return token_output.token_digest(spark, path)


def _with_settings(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.settings(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, _with_settings(stage)) for name, stage in (
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
)]

#: SQL can't express the classifier, the fingerprints or the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

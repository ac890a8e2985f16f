"""The three text tables as (key, text) inputs, shared by queries and workflow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.sources.tables import spread, table


def documents(spark: SparkSession, sf_dir: str, cols=("doc_id", "text")) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select(*cols), "doc_id")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id")


def pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shroud.sources.files import html_to_text
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", html_to_text(F.col("html")).alias("text"))

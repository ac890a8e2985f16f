import pytest


@pytest.fixture(scope="session")
def make(spark):
    """rows -> DataFrame of documents (doc_id, text, lang, source, n_chars), over several partitions."""
    def build(rows, schema="doc_id bigint, text string, lang string, source string, n_chars bigint", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return build

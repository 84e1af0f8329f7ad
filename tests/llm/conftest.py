import os

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark: SparkSession):
    """Documents from (id, text) pairs, with extra columns whose names clash with inner ones."""
    def make(pairs, lang="en", source="src0"):
        rows = [(i, t, lang, source, len(t or ""), "x", 7, 0.5) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "_text string, k int, score double")
    return make


@pytest.fixture(scope="session")
def sf_docs():
    import duckdb
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def sf(spark):
    assert os.path.isdir(SF)
    return SF

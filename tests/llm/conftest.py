import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A table like `documents` from texts, numbered from 0 or with the given ids."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def texts(spark):
    """All texts of the smallest table, by id."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture
def cluttered():
    """Adds columns whose names clash with results or helpers."""

    def add(df, *names):
        return df.withColumns({n: F.lit("x") for n in names})

    return add

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, source) rows, over some partitions."""
    def make(rows, partitions=3):
        full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)
    return make


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table, in Spark and as (doc_id, text) pairs."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]

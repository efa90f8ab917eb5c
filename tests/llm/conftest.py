import pytest

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture
def documents(spark):
    """A table of documents with columns whose names operators use themselves."""

    def make(rows, schema="doc_id long, text string, lang string, source string, row string, hits long, of long, host string"):
        width = len(schema.split(","))
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return make

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # Names that operators use inside or add.
        StructField("score", StringType()),
        StructField("copies", StringType()),
        StructField("row", StringType()),
        StructField("replaced", StringType()),
        StructField("hash", StringType()),
        StructField("fingerprint", StringType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """A table like ``documents`` with extra columns of clashing names, from (doc_id, text[, source])."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, source = (*row, "s")[:3]
            full.append((doc_id, text, "en", source, len(text or ""), *["own"] * 6))
        return spark.createDataFrame(full, DOCS)

    return make


ODD_ROWS = [(1, "One two three four five six seven."), (1, "One two three four five six seven."), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "),
            (None, "a row without an id"), (5, "é ñ 漢字 \U0001f600 x"), (6, "x" * 50_000), (7, "word " * 30_000), (8, "dup"), (8, "other")]


@pytest.fixture
def odd_docs(docs_of):
    """Null, empty and blank texts, a null id, repeated rows and ids, very long words and texts."""
    return docs_of([(*row, None if i % 4 == 0 else f"s{i % 3}") for i, row in enumerate(ODD_ROWS)])

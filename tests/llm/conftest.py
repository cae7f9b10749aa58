import pytest
from pyspark.sql import types as T

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Columns that the operators use themselves, as extra columns of the input.
CLASHING = ["found", "node", "own", "copies", "score", "kept", "w", "n_words", "copy", "doc", "line", "key", "text_"]

DOCUMENT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in CLASHING]
)


@pytest.fixture
def docs_of(spark):
    """Documents from pairs of id and text, with clashing columns."""
    def build(*pairs):
        return spark.createDataFrame([(i, t, *["x"] * len(CLASHING)) for i, t in pairs], DOCUMENT)

    return build


def prose(first, count, stem="word"):
    return " ".join(f"{stem}{k}" for k in range(first, first + count))


@pytest.fixture
def odd_docs(docs_of):
    """Null ids and texts, empty and blank texts, a very long one, equal rows and equal ids."""
    return docs_of(
        (None, prose(0, 70)), (None, None), (1, None), (2, ""), (2, ""), (3, " \n\t\n"), (4, prose(0, 70)),
        (5, prose(0, 200_000)), (6, prose(500, 60)), (6, prose(500, 60)), (6, prose(900, 60)), (7, "é\u00a0x 1\x00"),
    )


@pytest.fixture
def no_docs(docs_of):
    return docs_of()

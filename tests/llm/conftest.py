import pytest
from pyspark.sql import types as T

#: Columns that clash with names that the operators use inside.
CLASHES = ("uid", "fp", "ids", "n", "score", "row", "sub", "value", "half", "size", "bin", "shared", "kept", "text_crc32", "component")

LONG = " ".join(f"mot{i % 977} clé{i % 13}" for i in range(30_000))
TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. " * 4), (1, "The quick brown fox jumps over the lazy dog. " * 4),
    (1, "The quick brown fox jumps over the lazy dog. " * 4), (2, None), (3, ""), (4, " \n\t "), (5, "one"), (6, "two words"),
    (7, LONG), (8, LONG + " end"), (9, "ÜBER straße Σίσυφος <|endoftext|> don't 12345  x​ 한국어 文字列\r\n\x01tail"), (None, "a text without an id " * 20),
    (10, "line one of it\nline two of it\nline one of it\n\nline two of it"), (11, "#tag $$$ %%% &&& ### *** " * 30), (12, "a" * 5000), (13, " " * 3000 + "x"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empties, copies, a very long text and clashing columns."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASHES])
    return spark.createDataFrame([(i, t, None if i == 6 else "en", *("x" for _ in CLASHES)) for i, t in TEXTS], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 4 != 0), int(i % 5 == 1)) for i in range(14)] + [(0, 1, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

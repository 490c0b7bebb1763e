import pytest
from pyspark.sql import types as T

from tests.conftest import spark  # noqa: F401  (the shared session)

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that results use, too.
        T.StructField("score", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("items", T.StringType()),
    ]
)
PROSE = " ".join(f"word{i}" for i in range(120))


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), "x", "y", "z", "w")


TRICKY = [
    row(1, PROSE),
    row(2, PROSE.replace("word60 ", "other ")),
    row(2, PROSE.replace("word60 ", "other ")),  # a repeated row
    row(3, None),
    row(4, ""),
    row(5, " \n\t\n "),
    row(6, "one"),
    row(7, "one", None),
    row(None, PROSE),
    row(8, "long " + " ".join(f"w{i % 7000}" for i in range(60_000)), None),
    row(9, "\n".join(["same line here"] * 5), "b"),
    row(10, "é ñ ü " * 30 + "password=hunter22", "b"),
]


@pytest.fixture(scope="session")
def tricky(spark):  # noqa: F811
    return spark.createDataFrame(TRICKY, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):  # noqa: F811
    return spark.createDataFrame([], SCHEMA)

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use inside must not disturb them.
        T.StructField("size", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("root", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make(spark, tmp_path_factory):
    """Rows of ``(doc_id, text, source)`` as a Parquet table with extra columns."""

    def build(rows):
        rows = [(*(tuple(row) + (None,) * 3)[:3], "x", "y", "z", "w", "r") for row in rows]
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        spark.createDataFrame(rows, SCHEMA).write.parquet(path)
        return spark.read.parquet(path)

    return build


PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty, blank and very long texts, ties and repeated rows."""
    return [
        (1, PROSE, "a"),
        (1, PROSE, "a"),
        (2, PROSE, None),
        (None, PROSE, "b"),
        (None, None, None),
        (3, None, "b"),
        (4, "", "b"),
        (5, " \n\t ", "b"),
        (6, "word", "c"),
        (7, "word word", "c"),
        (8, " ".join(f"w{i}" for i in range(60_000)), "c"),
        (9, "x" * 300_000, "c"),
        (10, "naïve Größe 中文 😀 é", "d"),
        (10, "another text of the same id", "d"),
    ]

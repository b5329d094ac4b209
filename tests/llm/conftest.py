import pytest
from pyspark.sql import types as T

#: Columns of edge documents: besides the needed ones extra columns that clash in name or case.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("TEXT", T.IntegerType()),
    T.StructField("Score", T.StringType()), T.StructField("ids", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("c0", T.StringType()),
])


@pytest.fixture(scope="session")
def frame(spark):
    """``frame(rows)``: documents from (doc_id, text[, lang]) tuples."""
    def make(rows):
        filled = [(r[0], r[1], r[2] if len(r) > 2 else "en", 1, "s", "i", "x", "y") for r in rows]
        return spark.createDataFrame(filled, SCHEMA).repartition(3)
    return make


@pytest.fixture(scope="session")
def edge(frame):
    """Nulls, empty, white space, repeated rows, a long text, accents, control characters."""
    long = " ".join(f"word{i % 977} of the long text number {i}" for i in range(9000))
    return frame([
        (1, None), (2, ""), (3, " \t\n "), (4, "a b c d e f"), (4, "a b c d e f"), (5, "A B C d e f"),
        (None, "no id here at all"), (None, None), (6, long), (7, long), (8, "ééé ñ ß 日本語 🙂 \x1c\x00 end"),
        (9, "The 12 apples cost $5.00 in 2 hours."), (10, "é" * 70), (11, "!!! ??? 123"),
    ])

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} and the rest{i % 13}" for i in range(40_000))
LINE = "the same long line stands in several of these texts and must stay only once " + " ".join(f"more{i}" for i in range(30))

#: Nulls, empty and very long texts, ties, repeated rows; extra columns whose names clash with those of the results.
ROWS = [
    (1, "one small text about a mit license", "en", "a", 33), (2, None, None, None, None), (3, "", "en", "a", 0),
    (4, LONG, "en", "a", len(LONG)), (5, LONG, "en", "b", len(LONG)), (6, LONG + " tail", "en", "b", len(LONG) + 5),
    (7, "x", "de", "b", 1), (7, "x", "de", "b", 1), (None, "a text without any id", "fr", None, 21), (9, "  \n\t ", "fr", "c", 5),
    (10, f"first words of ten\n{LINE}", "en", "c", 90), (11, f"{LINE}\nother words of eleven", "en", "c", 90),
    (12, f"{LINE} today\nlast words", "en", "c", 90), (13, "Σίσυφος ΣΑΣ <|endoftext|> don't été 漢字 \u0001", "el", "c", 30),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
CLASHES = ("keep_id", "size", "bucket", "row", "group", "n", "sig", "score", "shard", "tie", "pos", "digests", "curve", "kept")


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")

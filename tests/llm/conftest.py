import pytest
from pyspark.sql import types as T

WORDS = "the of and thonere ingand. Erth, tionhe éçole über niño 12 a.b x_y reand onon".split()


def text(seed: int, size: int) -> str:
    return " ".join(WORDS[(seed * 7919 + i * i * 31 + i * seed) % len(WORDS)] for i in range(size))


#: doc_id, text, source: nulls, empty texts, ties, repeated rows, one long text, near copies.
ROWS = [
    (0, "", "b"),
    (1, None, "a"),
    (2, " \t\n\x0b\x0c\r ", "a"),
    (3, "one", "é"),
    (4, "One", "z"),
    *[(i, text(i, 40 + i), "ab"[i % 2]) for i in range(5, 30)],
    (30, text(5, 45), None),
    (31, text(6, 46) + " more", "b"),
    (32, text(6, 46), "b"),
    (33, text(99, 30_000), "c"),
    (34, "日本語 text 🙂 " * 30, "c"),
    (34, "日本語 text 🙂 " * 30, "c"),
    (35, "a" * 5000, "c"),
    (None, text(7, 47), "a"),
    (None, None, None),
    (2000, text(40, 60), "b"),
    (5000, "  x   y  z\n\n 's it's", "a"),
]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # names that operators use inside or return
        T.StructField("row", T.StringType()), T.StructField("fingerprint", T.IntegerType()),
        T.StructField("_weight", T.DoubleType()), T.StructField("c0", T.StringType()),
        T.StructField("start", T.BooleanType()),
    ]
)


def rows():
    return [(i, t, s, None if t is None else len(t), "r", 7, 0.5, "c", True) for i, t, s in ROWS]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

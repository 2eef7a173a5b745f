import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns with names that operators use inside.
CLASHING = (
    "score double, predicted int, kept boolean, root bigint, keys string, key string, u string, v string, shard int, slot int, size int, "
    "secrets string, ids string, words string, lines string, host string, label string, _k1 string, restored string, near string"
)

LONG = " ".join(f"w{i}" for i in range(30_000))
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"

EDGE_ROWS = [
    (1, COPY, "en", "a", 3),
    (2, COPY.upper(), "en", "a", 3),
    (2, COPY.upper(), "en", "a", 3),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, " \t\n\x0b\x0c\r ", "en", "a", 1),
    (6, LONG, "en", "b", 1),
    (7, LONG + " more", "en", "b", 1),
    (None, COPY, "en", "a", 1),
    (None, None, None, None, None),
    (8, "short text", "en", "a", 1),
    (9, "SHORT  text", "en", None, 1),
    (10, "éß \U0001f600 |pipe| $   end", "fr", "a", 1),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    for column in CLASHING.split(", "):
        name, kind = column.split(" ")
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()

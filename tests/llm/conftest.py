import pytest
from pyspark.sql import types as T

CLASHING = (
    "__w __l __g __h1 __h8 __lang __q __kept __base_failed __head __u __size __source __again __copies __total"
    " __offset __row __bucket __n __place __key __id __packed __by Shard fp point n tokens word runs"
).split()
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Further columns whose names the operators use themselves.
        T.StructField("row", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("root", T.StringType()),
        T.StructField("odd.name", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in CLASHING],
    ]
)
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "r", "s", "i", "o", "d", *CLASHING)


def sentence(seed, n=60):
    """Deterministic prose without repeated windows."""
    found, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        found.append("w" + "abcdefghijklmnopqrst"[state >> 8 & 15] + str(state >> 12 & 4095))
    return " ".join(found)


ROWS = [
    document(1, sentence(1)),
    document(2, sentence(1)),  # a copy
    document(3, sentence(1) + " end"),  # a near copy
    document(4, sentence(4), source="b"),
    document(4, sentence(4), source="b"),  # a repeated row
    document(None, sentence(5), source=None),
    document(6, None, lang=None),
    document(7, ""),
    document(8, " \n\t "),
    document(9, sentence(9, 20_000), source="b"),  # very long
    document(10, "x" * 100_000),  # one very long word
    document(11, "ab " * 3000),  # one repeated word
    document(12, "İstanbul ÄÖÜ naïve 東京 " * 30, lang=None),
    document(13, "two words"),
    document(14, None, source=None),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


@pytest.fixture(scope="session")
def no_items(spark):
    return spark.createDataFrame([], ITEMS)


@pytest.fixture(scope="session")
def corpus(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

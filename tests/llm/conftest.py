import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, __node string, `a.b` int"
LONG = "the quick brown fox jumps over the lazy dog again and again " * 4000


def rows(texts):
    return [(i, t, "en" if i % 2 else "de", "src0", len(t or ""), "clash", "mine", i) for i, t in texts]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a few words here"), (5, "a few words here"), (6, "a few words here"), (7, LONG), (8, "日本語テキスト。123 <s>"), (9, "a" * 200_000), (-3, "minus")]
    return spark.createDataFrame(rows(texts) + [(None, "no id at all", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

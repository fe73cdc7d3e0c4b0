import pytest

pytest.importorskip("gleanspark.llm")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, component_id long, Kept string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls anywhere, empty and very long texts, ties, repeated rows and ids, and columns named like outputs."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    texts = [None, "", "   ", "A", "a", "Hello world again and again", "hello WORLD again and again", long, long + " end", "\x00\x01", "日本語 テキスト", "x" * 5000, "MIT License", "é É", None]
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "", "b", "a"][i % 4], None, 7, 8, "k") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "hello world again and again", "en", "a", 1, 1, 1, "k"), (5, "another text", "en", "a", 1, 1, 1, "k")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

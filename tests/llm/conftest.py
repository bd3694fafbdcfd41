import pytest

ODD_TEXTS = [None, "", " ", "\n\n", "one", "a b c d", "é ü▁ 中文 𝄞", "word " * 60_000, "x" * 300_000]


@pytest.fixture
def odd_docs(spark):
    """Null and repeated ids, null and repeated rows, empty and very long texts, columns of clashing names."""
    rows = [(i, t, None if i % 2 else "s", i, "q") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "lost id", None, None, None), (None, None, None, None, None), rows[4], rows[4], (5, "another text of this id", "s", 1, "q")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, `copies` string").withColumnsRenamed({"copies": "rate"})


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)

import pytest
from llm_texts import prose

ODD_TEXTS = [
    None, "", " ", "a", "A a", "\t\n\x0b\x0c\r ", "x" * 5000, "naïve Ünïcode ΑΒΓ 日本語 🙂 text", "one two three",
    "one  two\tthree", "ONE two THREE", "<|endoftext|> in <|endoftext|>text", "don't we'll I'M 123 456,789", prose(9000, 1),
    prose(300, 2), prose(300, 2), "same same same same same same",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "kept", -1.0, 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[14], rows[14], (None, "null id text here", None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "`odd.name` string, score double, n_words long")


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark, odd):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(17)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(labels):
    return labels.limit(0)


def as_rows(df):
    return sorted(map(repr, df.collect()))

import pytest

from tidemark.llm.shared import session

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def llm_spark(spark):
    return session(spark)


def awkward(spark):
    """Nulls, empty and long texts, repeated rows, white space only, and columns that operators might use themselves."""
    long = "A quiet street with many trees led down to the harbour. " * 3000
    rows = [(1, "The cat sat on the mat and looked at the birds outside the window today.", "en"), (1, "The cat sat on the mat and looked at the birds outside the window today.", "en"),
            (2, None, None), (None, "No key here but some words to read for everyone who passes by.", "en"), (3, "", "en"), (4, " \n\t ", "en"), (5, long, "en"),
            (None, None, None), (6, "ünïcödé Straße \U0001f600 " * 10, "de"), (7, "x" * 50_000, "en")]
    return spark.createDataFrame([(*r, "n_words", "text", 1) for r in rows],
                                 "doc_id bigint, text string, lang string, n_words string, fp string, _votes int")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

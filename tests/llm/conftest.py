import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, score string, kept string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with extra columns whose names clash with those of results."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", "x", "y", "z") for i, t in rows], SCHEMA)
    return make


def odd_rows():
    """Null and empty texts, a null id, repeated rows, ties and a very long text."""
    long = "aa bb cc dd ee ff gg " * 30_000
    return [(1, None), (2, ""), (3, " \n\t"), (None, "one two three four five six"), (4, "same text here"), (4, "same text here"),
            (5, "same text here"), (6, long), (7, "Ünï ÇÀ 漢字 12 x@y.zz +1 (555) 123-4567 1.2.3.4"), (8, "!!!")]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(odd_rows())


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])

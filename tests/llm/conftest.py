import random

import pytest

#: Columns that operators use inside; none may be disturbed by them.
CLASHING = ("doc", "text2", "same", "line", "rest", "row", "key", "id", "bucket", "component", "n")


def words(rng, n, vocabulary=4000):
    return [f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(n)]


def sentence_lines(rng, lines):
    return "\n".join(" ".join(words(rng, rng.randint(3, 14))) for _ in range(lines))


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, one very long one, repeated rows and odd characters."""
    rng = random.Random(9)
    long = " ".join(words(rng, 60_000))
    return [None, "", " \n\t ", "one", "a\x00b   é́ \x1c x", long, "same text\nsame text\nsame text", "same text\nsame text\nsame text", "Ünï côdé " * 30, "\n\n\n", "z" * 5000]


@pytest.fixture
def documents(spark):
    """A function from texts to a table of documents with extra columns whose names clash."""

    def make(texts, ids=None):
        extra = ", ".join(f"{c} string" for c in CLASHING)
        rows = [(i if ids is None else ids[i], t, "en", "src", len(t or ""), *(f"{c}{i}" for c in CLASHING)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").repartition(3)

    return make

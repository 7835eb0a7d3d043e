import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(60_000))


@pytest.fixture
def make(spark):
    """Documents from (id, text) pairs, with columns that clash with names the operators add."""

    def build(rows, lang="en"):
        data = [(i, t, lang, "s", len(t or ""), 1.5, "x") for i, t in rows]
        return spark.createDataFrame(data, SCHEMA + ", score double, hash string").repartition(3)

    return build


@pytest.fixture
def odd():
    """Nulls, empty and very long texts, repeated rows, equal texts under several ids."""
    return [(1, None), (2, ""), (3, "a"), (4, "one two three four five six. Seven!\n"), (4, "one two three four five six. Seven!\n"), (5, LONG), (None, "no id here"), (6, "é \U0001f600\n\n x")]

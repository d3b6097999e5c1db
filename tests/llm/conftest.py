import pytest

from stratalake.llm.tables import ready


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the settings of the subpackage."""
    return ready(spark)


@pytest.fixture
def documents(llm):
    """Documents of (doc_id, text) pairs with the other columns of the table and one more of a clashing name."""

    def make(pairs):
        schema = "doc_id long, text string, lang string, source string, n_chars long, count long, Fingerprint string"
        rows = [(i, t, "en", "s", None if t is None else len(t), 7, "x") for i, t in pairs]
        return llm.createDataFrame(rows, schema)

    return make

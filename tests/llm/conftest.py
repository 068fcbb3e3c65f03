import pytest

from tallycheck.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, _items string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Make documents from (doc_id, text[, source]); with columns whose names clash with added ones."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 0.5, "mine", "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make

import pytest


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, source) as a table, with columns whose names clash with the operators' own."""

    def make(rows, **types):
        kinds = {"doc_id": "long", "text": "string", "source": "string"} | types
        full = [tuple(row) + (None,) * (len(kinds) - len(row)) for row in rows]
        frame = spark.createDataFrame(full, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))
        return frame.selectExpr("*", "1 AS size", "'x' AS ids", "2.0 AS score", "'y' AS labels", "3 AS n")

    return make


@pytest.fixture
def clashing(documents):
    """The same, with columns named like those that operators add on their way."""
    names = "_id _text _key _slice _chance _place _mark _from _n _class _row kept_id _live _copy".split()

    def make(rows, **types):
        return documents(rows, **types).selectExpr("*", *(f"'{name}' AS {name}" for name in names))

    return make

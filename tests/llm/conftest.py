from __future__ import annotations

import pytest

LONG = "alpha beta gamma delta " * 9000


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, source]) rows, with columns whose names the operators use inside."""

    def make(rows):
        rows = [(i, t, (rest[0] if rest else "s"), 7, "x", 1) for i, t, *rest in rows]
        kinds = "doc_id long, text string, source string, _id int, key string, level int"
        return spark.createDataFrame(rows, kinds)

    return make


@pytest.fixture(scope="session")
def awkward(frame):
    """Null ids and texts, empty and very long texts, ties and repeated rows."""
    return frame(
        [
            (1, "One line here.\nAnother line here.\nOne line here."),
            (1, "One line here.\nAnother line here.\nOne line here."),
            (1, "same id, other text"),
            (2, None, None),
            (3, "", None),
            (4, " \t\n "),
            (None, "one LINE here.\nA fresh line, for once."),
            (None, None, None),
            (5, LONG),
            (6, LONG + "x"),
            (7, "é É ÉCOLE ecole\r\none line here. "),
            (8, "\x00 odd \x1c bytes \U0001f600   here"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])

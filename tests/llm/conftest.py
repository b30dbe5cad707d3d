"""Small documents with every awkward case: nulls, empty and long texts, copies, clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import Row

LONG = " ".join(f"w{i * i % 977}x{i}" for i in range(3000))
PROSE = (
    "The river bends twice before the mill and then runs straight for a mile, past the orchard, the\n"
    "old weir and the two stone bridges that the county rebuilt after the flood. Nobody in the village\n"
    "remembers who planted the poplars along the bank, but every spring the council argues about them,\n"
    "and every autumn the leaves block the sluice and someone has to wade in with a rake and a lamp."
)
LEAK = "which of the following metals is liquid at room temperature and was once used in common thermometers for fever"


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    return [
        (1, PROSE, "en", "a", "x"),
        (2, PROSE, "en", "a", "x"),
        (2, PROSE, "en", "a", "x"),
        (3, PROSE.replace("sluice", "culvert"), "en", "b", "y"),
        (4, "", "en", "b", None),
        (5, None, None, None, None),
        (None, None, "en", None, "z"),
        (None, PROSE, "en", None, "z"),
        (6, LONG, "xx", "c", "z"),
        (7, LONG + " tail", "xx", "c", "z"),
        (8, "one", "", "c", "z"),
        (9, "1234 5678 !!!", "en", "c", "z"),
        (10, "Before it. " + LEAK + " After it.", "en", "d", "z"),
        (11, "ab " * 400, "en", "d", "z"),
        (12, "a b été \U0001f600 \x1c \t\n\x0b", "fr", "d", "z"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows, with columns named like those that the operators make."""
    schema = "doc_id long, text string, lang string, source string, n_words string"
    return spark.createDataFrame(odd_rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_words string")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [Row(item_id=1, text=LEAK), Row(item_id=2, text=None), Row(item_id=3, text=""), Row(item_id=None, text="no")]
    return spark.createDataFrame(rows, "item_id long, text string")

"""Small documents with every awkward case; brute-force helpers."""

import re

import pytest

LONG = "word" * 20_000
BASE = " ".join(f"alpha{k} beta{k % 7} gamma{k % 11}" for k in range(60))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, copies, repeated rows, clashing extra columns."""
    near = BASE.replace("alpha30", "omega")
    rows = [
        (1, BASE, "x"), (2, BASE, "y"), (3, near, None), (4, None, "z"), (5, "", ""), (6, LONG, "x"), (7, "one two", "q"),
        (8, "one two", "q"), (8, "one two", "q"), (None, BASE, "n"), (9, "password = hunter2xyz AKIA" + "A1" * 9 + " " + "ab" * 13, None),
        (10, "<|endoftext|> tail \x00 end é\U0001f642", "x"), (11, "a " * 3000, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, score string").selectExpr(
        "doc_id", "text", "score", "score as block", "score as class_id", "score as bucket")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def word_list(text):
    return [w for w in re.split(rb"[ \t\n\x0b\x0c\r]+", (text or "").encode().lower()) if w]

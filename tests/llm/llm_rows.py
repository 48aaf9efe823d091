"""Rows and fixtures shared by the tests of this folder."""

import pytest

LONG = " ".join(f"word{i % 997}x{i % 7}" for i in range(20000))
BODY = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron."
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
          "key string, row int, hash string, shard int, matches string, label int")


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, a very long one, a null id, copies and repeated rows."""
    texts = [(1, None), (2, ""), (3, LONG), (4, BODY), (5, BODY), (5, BODY), (None, BODY),
             (6, " \n\t "), (7, "É ñ ß 日本 😀\r\nx"), (8, "one"), (9, None)]
    return spark.createDataFrame(
        [(i, t, None, "s", len(t or ""), None, "k", 1, "h", 3, "m", None) for i, t in texts],
        SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def by_id(df):
    """Rows as a dict from doc_id to the list of its rows."""
    found = {}
    for row in df.collect():
        found.setdefault(row["doc_id"], []).append(row)
    return found

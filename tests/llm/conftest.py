from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int) -> str:
    """Made-up words that differ from seed to seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join("bcdfglmnprst"[(x >> s) % 12] + "aeiou"[(x >> (s + 3)) % 5] for s in (4, 9, 14)))
    return " ".join(out)


@pytest.fixture(scope="session")
def prose():
    return words


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those of results."""

    def build(rows, clashing: bool = False):
        found = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], SCHEMA)
        if clashing:
            for name in ("score", "gone", "topic", "item_id", "component_id", "line", "at", "label", "n_words", "__id", "bucket", "u", "part"):
                found = found.selectExpr("*", f"doc_id AS {name}")
        return found

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, without words, and a very long text without line breaks."""
    return [None, "", " \n\t ", "?!... --", words(99, 30_000)]

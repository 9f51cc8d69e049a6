from __future__ import annotations

import pytest

LONG = " ".join(f"lang{i % 977} wort{i % 1009}" for i in range(60_000))

TEXTS = [
    None,
    "",
    " \t\n\r\x0b\x0c ",
    "one",
    "one two",
    "Ünïcode wörter and 日本語 with spaces",
    LONG,
    "the same words again and again\nthe same words again and again\nand one line more than that",
    "a|b|c * # $ % & <tag> ### $$$ ***",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rows = [(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[7], (None, "no id at all but some words", None, None, None), (None, None, None, None, None)]
    rows += [(7, "another text under the same doc_id as before", "en", "src1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = "'x' AS shard", "1.5D AS size", "7 AS kept", "array(1) AS bucket", "'y' AS u", "'z' AS key", "0 AS component"
    return spark.createDataFrame(rows, schema).selectExpr("*", *extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

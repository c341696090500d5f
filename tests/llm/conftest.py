import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(*rows):
        full = [(*r, "en", "src1")[:4] + (len(r[1] or ""),) if len(r) < 4 else (*r, len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, blanks, a very long text, repeated rows, ties, and extra columns that clash with names used inside."""
    long = " ".join(f"w{i % 997} x{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "one two three four five six"), (5, "one two three four five six"),
            (6, "one  two three\tfour five six"), (None, "one two three four five six"), (None, None), (7, "é 😀 ß"),
            (8, "same text of two rows with one id"), (8, "another text of the same id")]
    extra = {"digest": 0, "fp": 1, "score": 2, "component": 3, "n": 4, "rows": 5, "whole": 6, "last": 7, "key": 8,
             "copy_of_row": 9, "root": 10, "keep_id": 11, "DIGEST_OF_TEXT": 12, "word": 13, "row": 14}
    return make_docs(*rows).withColumns({k: F.lit(v) for k, v in extra.items()})

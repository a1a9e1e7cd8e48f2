import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))
sys.path.insert(0, str(Path(__file__).parents[1]))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) pairs or longer rows."""

    def make(rows, **more):
        full = [(*row, None, None, None)[:5] for row in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        return df.withColumns({name: F.lit(value) for name, value in more.items()})

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, repeated rows."""
    long_text = " ".join(f"word{i % 700} mix{i % 13}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, "   \t\n"), (None, "a text without an id, but with a few words"), (None, None), (5, long_text),
        (6, "twice the same row of some words"), (6, "twice the same row of some words"), (7, "?!... 12 34"), (8, "ünïcödé wörds ärë fïnë – ok"),
    ]

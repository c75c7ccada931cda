from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest table: 200 whole documents."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, null and repeated ids, a very long text, rows that repeat, columns of names in use."""
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \t\n ", "en", "a"), (4, "one two", "en", "a"),
        (5, LONG, "en", "b"), (5, LONG, "en", "b"), (None, "no id at all here", "fr", "b"), (6, "12 34 !!", "de", "b"),
        (7, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end', "en", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    clash = (
        "score", "fp", "id", "n_tokens", "ids", "spans", "hit_spans", "_packed", "key", "words", "host", "n_chars", "copy",
        "_spans", "_cut", "_span_id", "contaminated", "predicted", "_row", "h", "c",
    )
    return df.withColumns({c: F.lit("mine") for c in clash})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")

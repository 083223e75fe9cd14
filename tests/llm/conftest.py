from __future__ import annotations

import pytest

#: Texts every operator has to take: none, empty, blank, short, repeated, long, odd characters.
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
EDGE = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "one"),
    (6, "Alpha beta gamma delta epsilon zeta eta theta iota kappa."),
    (6, "Alpha beta gamma delta epsilon zeta eta theta iota kappa."),
    (7, "tie tie tie tie tie tie tie tie tie tie tie tie"),
    (None, "A row without a key, but with words enough for shingles."),
    (8, LONG),
    (9, "naïve café 文字 😀 \u0000   end"),
    (7, "the same key with another text of several words here"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with every odd case, and columns named like those that operators add."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(EDGE, SCHEMA)
    clash = ["fingerprint", "component_id", "score", "predicted", "held_out", "spans", "token_ids", "decoded", "shard", "slot", "bytes", "doc", "item", "item_id", "n", "gram", "key", "features", "n_mail", "lang", "at", "row"]
    return docs.withColumns({c: F.lit(f"own {c}") for c in clash})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def llm_docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")

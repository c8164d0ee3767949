from __future__ import annotations

import pytest

LONG = "long text with many words " * 20_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from here.", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from here.", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from here.", "en"),
    (2, "another text of a repeated id", "en"),
    (3, None, "en"),
    (4, "", None),
    (None, "a text without an id", "en"),
    (None, None, None),
    (5, " \n\t ", "de"),
    (6, LONG, "en"),
    (7, "<|endoftext|> don't  İstanbul ΣΑΣ é 日本語 12345   ½ 'll''s", None),
    (8, "!!! 123 ???", "fr"),
    (-9, "Der schnelle braune Fuchs springt über den faulen Hund und läuft weg.", "de"),
]
# names that the operators use inside, on columns that are none of their business
CLASHES = ["key", "part", "fp", "size", "shard", "slot", "n", "ids", "x0", "held", "learns", "mark", "root", "range", "tie", "component_id", "score", "kept", "chunk", "t"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    extra = [None if i % 2 else "x" for i in range(len(CLASHES))]
    return spark.createDataFrame([(i, t, lang, None, None, *extra) for i, t, lang in TEXTS], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

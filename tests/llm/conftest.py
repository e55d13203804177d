from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

SF_DIR = os.environ.get("STRATA_TEST_DIR", "/root/testdata/sf0.001")

WORDS = " ".join(f"w{i}" for i in range(60))
SPACED = "\t w1  w2\n\n w3\x0b\x0c w4\r w5 "
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000)) + " " + WORDS
# Rows with nulls, empty and very long texts, ties and repeats: (doc_id, text, lang, source).
AWKWARD = [
    (1, WORDS, "en", "a"),
    (2, f"before {WORDS} after", "en", None),
    (3, WORDS, None, "a"),
    (3, WORDS, None, "a"),
    (4, None, "de", "b"),
    (5, "", "de", "b"),
    (6, SPACED, "fr", ""),
    (7, LONG, "fr", "b"),
    (8, "a b", "", "c"),
    (9, "A  B", "es", "c"),
    (10, "same same same " * 40, "es", "c"),
    (11, "same same same " * 40, "es", "d"),
    (12, "é" * 3000, "es", "d"),
    (13, "x" * 50_000, "es", None),
    (None, WORDS, None, None),
    (None, None, None, None),
    (-5, "line\nline\n\nline\r\n <b>*", "en", "d"),
]
# Names that the operators use within.
CLASHES = ["key", "kept", "hub", "block", "part", "shard", "slot", "n_words", "base", "size", "copies", "first", "hash", "id", "bucket", "last", "edge", "rule"]


@pytest.fixture(scope="session")
def awkward(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string, lang string, source string")
    return docs.select("*", *(F.lit("clash").alias(name) for name in CLASHES))


@pytest.fixture(scope="session")
def pairs():
    return [(i, text) for i, text, _, _ in AWKWARD]


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (3, 0, 0), (3, 1, 0), (7, 1, None), (None, 0, 0), (10, None, 0)], "doc_id bigint, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [tuple(row) for row in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, kept string")

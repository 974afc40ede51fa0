"""Fixtures of these tests; test modules import the ones they use (a second conftest would hide the first)."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture
def odd_docs(spark):
    """Null ids and texts, empty and blank texts, repeated rows, clashing extra columns."""
    words = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, words, "x", 0),
        (2, words, "y", 1),
        (2, words, "y", 1),
        (3, None, None, None),
        (4, "", "", 0),
        (5, " \n\t ", "z", 3),
        (None, words, "n", 2),
        (None, None, "n", 2),
        (6, "one", "w", 5),
        (7, "é" * 5000 + " " + "ab " * 3000, "long", 7),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, _row string, _id bigint")

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names operators use themselves."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
    passage = "the quick brown fox jumps over the lazy dog while seven wise owls look down from the old oak tree and count the stars of the northern sky until the morning light " * 2
    rows = [(1, "", None, "a", 0), (2, None, None, None, None), (None, "alone\nline", "en", "a", 10), (None, None, None, None, None), (3, long, "en", "b", len(long)), (4, long, "en", "b", len(long))]
    rows += [(5, passage, "en", "b", 1)] * 3 + [(6, "first\n" + passage, "en", "c", 1), (7, "a@b.example +1 (988) 555-2485 4041894974608795 10.2.3.4", "en", "a", 1), (8, "\n\n \n", "de", "", 1), (9, "...", "de", "", 1), (10, "?!", "de", "", 1)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.selectExpr("*", "1 AS piece", "'x' AS key", "2 AS sequence_id", "3 AS label", "4 AS k1", "5 AS lane", "6 AS h", "7 AS base", "8 AS n", "9 AS `_len`")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty and very long texts, ties, repeated rows and columns with clashing names."""
    rows = [(1, "the quick brown fox jumps over the lazy dog " * 3, "x", 1), (2, None, None, None), (3, "", "y", 2),
            (None, "the quick brown fox jumps over the lazy dog " * 3, "z", 3), (None, None, None, None),
            (1, "the quick brown fox jumps over the lazy dog " * 3, "x", 1), (4, "a" * 50_000, "x", 4),
            (5, "word " * 20_000, "x", 5), (6, " \t\n ", "x", 6), (7, "Σίσυφος ΑΣ \U0001F600 é <|endoftext|>", "q", 7),
            (8, "mail a@b.co card 4111 1111 1111 1111 ip 1.2.3.4 tel +1 (555) 123-4567", "q", 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, pii string, fp long").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")

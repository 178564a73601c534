"""Small tables for the tests of this folder."""

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, words string, hash string, "
          "size string")


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered from 0, with columns that clash with inner names."""
    def make(texts, first=0):
        rows = [(i + first, t, "en", "s", 1, "x", "y", "z", "u") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)
    return make


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

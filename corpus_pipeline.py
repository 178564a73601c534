"""The corpus pipeline: documents through toxicity, near copies, benchmark items, secrets and packing.

Stages take documents (doc_id, text, lang, source, n_chars) and ignore columns beyond these, whatever their names. Null and
empty texts and rows without doc_id pass the filtering stages; repeated rows share their fate; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm.decontaminate import without_items
from gradeloom.llm.jaccard import one_of_each
from gradeloom.llm.packing import pack
from gradeloom.llm.queries import table, tokenizer_path
from gradeloom.llm.secrets import find_secrets
from gradeloom.llm.toxicity import without_toxic
from gradeloom.session import work_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REDACTED = "[SECRET]"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, rejects go.

    Null and empty texts score as the classifier's constant; without labels all stay.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"), COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents that with the smallest doc_id stays.

    Rows that repeat its doc_id stay with it; rows without doc_id or without words are no copies and stay.
    """
    return one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows of their doc_id with them; rows without doc_id stay."""
    return without_items(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every row stays. Null texts stay null, and so does their n_chars."""
    found = find_secrets(docs, ["doc_id", "lang", "source"], REDACTED)
    return found.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens.

    A null text is empty; each row, repeated or without doc_id, is packed as a document of its own.
    """
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]
#: A learned classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result is written to a new folder below the work folder and read again.

    The rows returned lie in the last of these folders, so the caller removes them. An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

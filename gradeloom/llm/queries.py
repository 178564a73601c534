"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm.chat import formatted_digest
from gradeloom.llm.collocations import collocations
from gradeloom.llm.decontaminate import contained_items
from gradeloom.llm.jaccard import near_groups
from gradeloom.llm.licenses import license_labels
from gradeloom.llm.lm import language_scores
from gradeloom.llm.negatives import hard_negatives
from gradeloom.llm.packing import pack
from gradeloom.llm.pii import personal_data_digest
from gradeloom.llm.secrets import secrets_digest
from gradeloom.llm.sql import SQL
from gradeloom.llm.suffixes import without_repeats
from gradeloom.llm.toxicity import remainder, toxicity
from gradeloom.llm.vectors import near_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the public tokenizers lie on this machine and, as a package, on the executors."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(table(spark, sf_dir, "documents"))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"), tokenizer_path(), remainder("doc_id", 5) == 1)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are made of control strings."""
    steering = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", steering), (-1, 1, "assistant", steering)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return formatted_digest(given.unionByName(added))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth vector's; each seventh row is put under the next label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_personal_data, op3_licenses, op4_secrets, op5_near_vectors, op6_toxicity,
    op7_language_scores, op8_suffix_dedup, op9_jaccard_join, op10_decontamination,
    op11_collocations, op12_chat_format, op13_hard_negatives,
)}

__all__ = ["QUERIES", "SQL", "table", "tokenizer_path"]

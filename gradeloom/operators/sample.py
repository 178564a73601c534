"""Split, folds and class balance for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradeloom.operators.ranks import hash_rank
from gradeloom.operators.smote import smote

SPLIT_SEED = 20240601
TEST_RATIO = 0.2
FOLDS = 4


def split(
    df: DataFrame,
    ratio: float = TEST_RATIO,
    seed: int = SPLIT_SEED,
    target: str = "target",
    group_by: str | None = None,
) -> DataFrame:
    """Add `split`: `ratio` of each class is 'test', the rest 'train'.

    With `group_by` whole groups (say learners) go to one side, and classes are not balanced.
    """
    if group_by is not None:
        side = hash_rank(df.select(group_by).distinct(), [], group_by, seed)
        test = side.where(F.col("rank") <= ratio * F.col("class_size")).select(
            group_by, F.lit("test").alias("split")
        )
        return df.join(test, group_by, "left").fillna("train", ["split"]).select(*df.columns, "split")
    ranked = hash_rank(df, [target], "row_id", seed)
    side = F.when(F.col("rank") <= ratio * F.col("class_size"), "test").otherwise("train")
    return ranked.select(*df.columns, side.alias("split"))


def folds(df: DataFrame, k: int = FOLDS, seed: int = SPLIT_SEED, target: str = "target") -> DataFrame:
    """Add `fold` 0..k-1, with the classes spread evenly."""
    ranked = hash_rank(df, [target], "row_id", seed)
    return ranked.select(*df.columns, F.expr(f"int((rank - 1) % {k})").alias("fold"))


def oversample(df: DataFrame, seed: int = 0, target: str = "target") -> DataFrame:
    """Repeat rows until each class is as large as the largest; `copy` numbers the repeats from 1."""
    ranked = hash_rank(df, [target], "row_id", seed)
    copies = F.expr("most div class_size + if(rank <= most % class_size, 1, 0)")
    return ranked.select(*df.columns, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy"))


def undersample(df: DataFrame, seed: int = 0, target: str = "target") -> DataFrame:
    """Keep as many rows of each class as the smallest has."""
    return hash_rank(df, [target], "row_id", seed).where("rank <= least").select(*df.columns)


def balance(df: DataFrame, method: str, features: list[str], seed: int = 0, target: str = "target") -> DataFrame:
    """Training rows with equal classes: `smote`, `smote_graph` (neighbours nearly exact, any size), `over`, `under`, or `none`."""
    if method == "none":
        return df.select(*features, target)
    if method == "over":
        return oversample(df, seed, target).select(*features, target)
    if method == "under":
        return undersample(df, seed, target).select(*features, target)
    if method in ("smote", "smote_graph"):
        made = smote(df, features, seed=seed, target=target, graph=None if method == "smote" else {})
        return df.select(*features, target).unionByName(made.select(*features, target))
    raise ValueError(f"unknown balance method {method!r}")

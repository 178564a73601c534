"""Exact seeded ranks of rows without one window per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def digest(id_column: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")))


def hash_rank(df: DataFrame, by: list[str], id_column: str, seed: int, digits: int = 4) -> DataFrame:
    """Add `rank` (1-based, by seeded digest of a unique id inside each `by` class) and sizes.

    `class_size` is the class's own, `most` and `least` are those of the largest and smallest class.

    A class can hold most rows, so it is cut by the first hex digits of the digest: rows are ranked
    inside a piece and moved on by the rows of all earlier pieces, which come from a table of at most
    16^digits rows for each class. More digits give smaller pieces and the same ranks.
    """
    marked = df.withColumn("digest", digest(id_column, seed)).withColumn(
        "piece", F.substring("digest", 1, digits)
    )
    pieces = marked.groupBy(*by, "piece").agg(F.count("*").alias("piece_size"))
    whole = Window.partitionBy(*by)
    pieces = pieces.select(
        *by, "piece",
        (F.sum("piece_size").over(whole.orderBy("piece")) - F.col("piece_size")).alias("before"),
        F.sum("piece_size").over(whole).alias("class_size"),
    )
    # a short table, so that its sizes are compared in one task
    every = Window.partitionBy()
    pieces = pieces.withColumns({"most": F.max("class_size").over(every), "least": F.min("class_size").over(every)})
    inside = Window.partitionBy(*by, "piece").orderBy("digest", id_column)
    return (
        marked.withColumn("place", F.row_number().over(inside))
        .join(pieces, [*by, "piece"])
        .withColumn("rank", F.col("before") + F.col("place"))
        .select(*df.columns, "rank", "class_size", "most", "least")
    )


def class_shares(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows and share of each class."""
    counts = df.groupBy(target).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / counts.agg(F.sum("rows")).scalar())

"""Running totals over sequences too long for one task.

A window hands a whole key to one task. Here the rows are range-partitioned by key and order instead,
so a long sequence spreads over many even blocks; totals run inside each block, and the few block
totals run over each other. The blocks are written before use, so a lost executor cannot cut them
anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gradeloom.session import materialize, shuffle_width


#: Rows that a block holds, about.
BLOCK_ROWS = 1_000_000


def range_blocks(df: DataFrame, keys: list[str], order: list[Column], blocks: int | None = None) -> DataFrame:
    """`df` with a column `block`: contiguous, even pieces of the order over all keys.

    There are as many as the rows ask for, and as the session shuffles into at least.
    """
    width = blocks or max(shuffle_width(df.sparkSession), -(-df.count() // BLOCK_ROWS))
    cut = df.repartitionByRange(width, *keys, *order).withColumn("block", F.spark_partition_id())
    return materialize(cut)


def before_block(totals: DataFrame, keys: list[str], folds: dict[str, str]) -> DataFrame:
    """Block totals (one row per key and block) folded over all earlier blocks of the key.

    `folds` maps a new name to an aggregate over the totals. A key has at most as many rows here as
    there are blocks.
    """
    part = f"partition by {', '.join(keys)}" if keys else ""
    earlier = f"({part} order by block rows between unbounded preceding and 1 preceding)"
    return totals.selectExpr(*keys, "block", *[f"{call} over {earlier} as {n}" for n, call in folds.items()])


def numbered(df: DataFrame, order: list[str], name: str = "row_id", blocks: int | None = None) -> DataFrame:
    """Number the rows from 0 along a unique order."""
    cut = range_blocks(df, [], [F.col(c) for c in order], blocks)
    before = before_block(cut.groupBy("block").agg(F.count("*").alias("n")), [], {"earlier": "sum(n)"})
    place = F.expr(f"row_number() over (partition by block order by {', '.join(order)}) - 1L")
    joined = cut.withColumn("place", place).join(before, "block")
    return joined.withColumn(name, F.col("place") + F.coalesce("earlier", F.lit(0))).drop("block", "place", "earlier")

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.session import gathered


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node reachable.

    Large-star and small-star steps by turns until nothing changes: every step hangs nodes on smaller ones,
    after a number of rounds that grows with the logarithm of the longest chain. A node with very many links
    is one key of a join whose other side is unique, so its rows can be split. Each round is cut off by a
    reliable checkpoint and goes on in as few partitions as its links fill.
    """
    kind = links.schema["a"].dataType
    edges = gathered(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = told(edges)
    while True:
        both = two_rows(edges, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        # large star: larger neighbours go to the smallest one
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
        edges = gathered(two_rows(moved, ("v", "m"), ("u", "m")).where("u <> v").distinct())
        now = told(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").cast(kind).alias("node"), F.col("v").alias("component")).unionAll(roots)


def two_rows(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each pair of columns of a row; the rows stay in their partition."""
    rows = F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs))
    return df.select(F.explode(rows).alias("r")).select("r.u", "r.v")


def told(edges: DataFrame):
    """The number of the links and a sum of their hashes."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

"""Near copies among vectors: p-stable hashing of normalised vectors, then exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.bytetext import STEP, mix
from gradeloom.llm.components import components
from gradeloom.llm.grouped import bounds, smallest_linked, whole_groups
from gradeloom.llm.shipping import ship
from gradeloom.session import materialize

COSINE = 0.9
#: Width of the quantised projections. Cells of about this width need the fewest tables.
WIDTH = 2.4
#: Vectors at right angles that may share a bucket by chance; a bucket takes more projections as vectors grow.
STRANGERS = 20
#: A pair at cosine COSINE shares one of the tables' buckets with at least these odds, whatever the count.
RECALL = 0.96
#: Vectors of a bucket that one task compares with as many others; larger buckets are cut into such parts.
PART = 1024


def odds(cosine: float) -> float:
    """Odds that two unit vectors at this cosine fall together in one quantised projection."""
    t = WIDTH / math.sqrt(2 - 2 * cosine)
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def shape(vectors: int) -> tuple[int, int]:
    """Projections in a bucket and number of tables for so many vectors."""
    k = max(4, math.ceil(math.log(max(vectors, 1) / STRANGERS) / -math.log(odds(0))))
    return k, math.ceil(math.log(1 - RECALL) / math.log(1 - odds(COSINE) ** k))


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lists of a column as rows of a matrix (shorter ones filled up with zeros), and their lengths."""
    lists = pa.chunked_array([column]).combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(np.asarray(lists.offsets))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), int(lengths.max(initial=0))))
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out, lengths


def unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, initial=0, keepdims=True)
    # only where squares would leave double precision, so that ordinary vectors keep their last bits
    extreme = (largest > 1e100) | (largest < 1e-100)
    rows = np.where(extreme, rows / np.where(extreme & (largest > 0), largest, 1), rows)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def buckets(vectors: DataFrame, k: int, tables: int, seed: int) -> DataFrame:
    """A row for each vector and table: (bucket, table, id, copies, codes of all tables, vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                rows, lengths = matrix(part.column(2))
                code = np.zeros((len(rows), tables), np.uint64)
                for size in np.unique(lengths).tolist():
                    if size not in drawn:
                        random = np.random.default_rng([seed, size])
                        drawn[size] = random.standard_normal((size, k * tables)), random.uniform(0, WIDTH, k * tables)
                    here = np.flatnonzero(lengths == size)
                    line, shift = drawn[size]
                    cell = np.floor((unit(rows[here, :size]) @ line + shift) / WIDTH).astype(np.int64).astype(np.uint64)
                    total = np.full((len(here), tables), size, np.uint64)
                    for j in range(k):
                        total = mix(total * STEP + cell[:, j::k])
                    code[here] = total
                code >>= np.uint64(32)  # the bucket follows from these bits alone
                bucket = mix(code + np.arange(1, tables + 1, dtype=np.uint64) * STEP)
                at = pa.array(np.repeat(np.arange(len(rows)), tables))
                cuts = pa.array(np.arange(0, (len(rows) + 1) * tables, tables).astype(np.int32))
                codes = pa.ListArray.from_arrays(cuts, pa.array(code.astype(np.uint32).view(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64).ravel()), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))),
                     part.column(0).take(at), part.column(1).take(at), codes.take(at), part.column(2).take(at)],
                    names=["bucket", "table", "id", "copies", "codes", "vector"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.select("id", "copies", "vector").mapInArrow(
        run, f"bucket long, table int, id long, copies long, codes array<int>, vector {kind}")


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted links and a spanning set of links of each cell (cell, side, table, id, copies, codes, vector).

    A cell holds one part of a bucket, or two parts to be compared with each other. A pair that shares buckets
    of several tables is taken in the first of them.
    """
    for group in whole_groups(batches):
        cell, both, table, ids, copies = (group.column(i).to_numpy() for i in (0, 1, 2, 3, 4))
        codes = np.asarray(group.column(5).combine_chunks().flatten()).reshape(len(ids), -1)
        rows, lengths = matrix(group.column(6).combine_chunks())
        rows = unit(rows)
        out_id, out_links, out_to = [], [], []
        cuts = bounds(cell)
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = slice(first, last)
            side = both[part]
            left = np.flatnonzero(side == side.min())
            right = np.flatnonzero(side == side.max())
            near = rows[first + left] @ rows[first + right].T >= COSINE
            if side.min() == side.max():
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            a, b = left[a], right[b]
            new = (codes[first + a, :table[first]] != codes[first + b, :table[first]]).all(axis=1) & (lengths[first + a] == lengths[first + b])
            a, b = a[new], b[new]
            if not len(a):
                continue
            own, weight = ids[part], copies[part]
            links = np.bincount(a, weights=weight[b], minlength=last - first) + np.bincount(b, weights=weight[a], minlength=last - first)
            to = own[smallest_linked(a, b, last - first)]
            linked = links > 0
            out_id.append(own[linked])
            out_links.append(links[linked].astype(np.int64))
            out_to.append(to[linked])
        if out_id:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_id, out_links, out_to)], names=["id", "links", "to"])


def near_vectors(vectors: DataFrame, id_: str = "vec_id", column: str = "embedding", seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector, whatever other columns there are.

    Two vectors link if their cosine in double precision is at least COSINE and they share a bucket; equal
    vectors always do. Vectors of different length, null, zero, or with null or non-finite parts link with
    nothing, as do rows without vec_id. Equal vectors are one node with its number of copies; rows that share
    a vec_id share its links. component_id is the smallest vec_id reachable. No rows give no rows.
    """
    ship(vectors.sparkSession)
    # floats are shipped as they are, cosines are taken in double precision
    kind = "array<float>" if vectors.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    value = F.col(column).cast(kind)
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = vectors.select(F.col(id_).cast("long").alias("id"), value.alias("vector"),
                          (F.coalesce(fine, F.lit(False)) & F.col(id_).isNotNull()).alias("fine"))
    nodes = rows.where("fine").groupBy("vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    k, tables = shape(vectors.count())
    filed = buckets(nodes.select(F.col("node").alias("id"), "copies", "vector"), k, tables, seed)
    # sizes of the buckets that hold more than one vector, and so the parts to cut them into
    sizes = filed.groupBy("bucket", "table").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select(
        F.col("bucket").alias("b"), F.col("table").alias("t"), F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    shared = filed.join(sizes, (F.col("bucket") == F.col("b")) & (F.col("table") == F.col("t")))
    own = F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int")
    cells = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("bucket", "table", F.least("own", "other"), F.greatest("own", "other"))
    cells = cells.select(cell.alias("cell"), "own", "table", "id", "copies", "codes", "vector")
    found = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "id long, links long, to long")
    found = materialize(found.groupBy("id", "to").agg(F.sum("links").alias("links")))
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    nodes = nodes.select("vector", "node", "copies").join(counted, F.col("node") == F.col("id"), "left").drop("id")
    nodes = nodes.join(reached.withColumnRenamed("node", "r"), F.col("node") == F.col("r"), "left").select(
        F.col("vector").alias("v"), "copies", "links", F.coalesce("component", "node").alias("component"))
    joined = rows.join(nodes, F.col("fine") & (F.col("vector") == F.col("v")), "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias("vec_id"), (F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))

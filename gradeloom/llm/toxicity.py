"""Toxicity by logistic regression over hashed n-grams and skip-grams, learned by FTRL-proximal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.bytetext import LOWER, STEP, flat, groups, hashes, mix, runs
from gradeloom.llm.shipping import ship

#: At most so many labelled rows are learned from, those with the smallest hash of doc_id.
SAMPLE = 12_000
BITS = 22
#: Learning rate and its offset, L1 and L2 strength, passes over the sample. L1 is well above the passes: what
#: few documents have never gets a weight.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 32.0, 0.1, 8
#: A feature is learned if so many documents of the sample have it.
LEAST_DOCS = 8
LEAST_SCORE = 0.7
HEADS = (4, 5, 6)

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of all words, their heads, pairs of words, and pairs with one word between them.

    Heads are a word's first four to six bytes, so that forms of a word have something in common.
    """
    low = LOWER[data]
    starts, ends = runs(WORD[data], offsets[1:-1])
    word, *heads = hashes(low, starts, ends, *(np.minimum(ends, starts + n) for n in HEADS))
    row = np.searchsorted(offsets[1:], starts, side="right")
    parts, rows = [word], [row]
    for n, head in zip(HEADS, heads, strict=True):
        longer = ends - starts > n
        parts.append(mix(head[longer] + np.uint64(n)))
        rows.append(row[longer])
    for gap in (1, 2):
        same = row[gap:] == row[:-gap]
        parts.append(mix(word[:-gap] * STEP + word[gap:] + np.uint64(gap))[same])
        rows.append(row[gap:][same])
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(rows)


def once(bucket: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket once per row, rows in order."""
    both = np.unique((row.astype(np.int64) << BITS) | bucket)
    return (both & ((1 << BITS) - 1)).astype(np.int32), both >> BITS


def examples(labelled: DataFrame) -> DataFrame:
    """Rows (at, toxic, buckets) of the labelled documents (at, toxic, text)."""
    ship(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(2))
            for a, b in groups(offsets):
                bucket, row = once(*features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                cuts = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(bucket))], names=["at", "toxic", "buckets"])

    return labelled.select("at", "toxic", "text").mapInArrow(run, "at long, toxic int, buckets array<int>")


def weight(z, n, l1: float):
    """The proximal step: zero unless z goes beyond the L1 strength; the rate falls with a coordinate's gradients."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(part: pd.DataFrame) -> pd.DataFrame:
    """Weights that are not zero; bucket -1 is the constant. Both classes weigh the same as a whole."""
    part = part.sort_values("at", kind="stable")
    seen = np.bincount(np.concatenate(part["buckets"].to_list()), minlength=1 << BITS)
    known = [b[seen[b] >= LEAST_DOCS] for b in part["buckets"]]
    share = part["toxic"].mean()
    heavier = (1 - share) / share if 0 < share < 1 else 1.0
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    for _ in range(PASSES):
        for bucket, toxic in zip(known, part["toxic"], strict=True):
            zs, ns = z[bucket], n[bucket]
            w, b = weight(zs, ns, L1), float(weight(bias_z, bias_n, 0.0))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - toxic
            g *= heavier if toxic else 1.0
            z[bucket] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            n[bucket] = ns + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * b
            bias_n += g * g
    w = weight(z, n, L1)
    kept = np.flatnonzero(w)
    return pd.DataFrame({"bucket": np.append(kept, -1), "weight": np.append(w[kept], weight(bias_z, bias_n, 0.0))})


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, sample: int = SAMPLE) -> dict[int, float]:
    """Weights by bucket, learned from documents with a label; -1 is the constant.

    Takes doc_id and text of `docs`, doc_id and toxic of `labels`; `learn_from` is a condition on doc_id. A
    document with several labels has the largest; null labels and null doc_ids are left out, null texts have no
    words. At most `sample` rows are learned from, so one task does it. There are at most 2**22 weights (L1
    leaves some hundreds), which go to the driver and from there to all tasks. Without any labelled row every
    document scores one half.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.col("text")).where(F.col("doc_id").isNotNull() if learn_from is None else learn_from)
    chosen = known.where(F.lit(True) if learn_from is None else learn_from)
    chosen = chosen.select("doc_id", "toxic", F.xxhash64(F.col("doc_id"), F.lit("toxicity")).alias("at")).orderBy("at").limit(sample)
    # `sample` rows of two numbers are small enough to send; of repeated rows one is enough, whichever
    labelled = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "at", "toxic").agg(F.max("text").alias("text"))
    weights = examples(labelled).withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(
        lambda part: learn(part), "bucket int, weight double")
    return {r.bucket: r.weight for r in weights.collect()}


def score(docs: DataFrame, weights: dict[int, float], columns: list[str]) -> DataFrame:
    """`columns` of `docs` and `score`, 0 to 1, from the whole column text (null: no words). One pass."""
    ship(docs.sparkSession)
    bias = weights.get(-1, 0.0)
    places = np.array(sorted(b for b in weights if b >= 0), np.int32)
    values = np.array([weights[b] for b in places.tolist()])
    sent = columns if "text" in columns else [*columns, "text"]  # the text travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << BITS, bool)
        known[places] = True
        for batch in batches:
            data, offsets = flat(batch.column(sent.index("text")))
            for a, b in groups(offsets, 1 << 20):  # rows go back as they are done, so that little is held at a time
                bucket, row = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                hit = known[bucket]
                bucket, row = once(bucket[hit], row[hit])
                total = bias + np.bincount(row, weights=values[np.searchsorted(places, bucket)], minlength=b - a)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(columns))), pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))], names=[*columns, "score"])

    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*sent).mapInArrow(run, f"{ddl}, score double")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of a key's decimal text, modulo `by`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; a third of the ids is held out of the learning.

    Null and empty texts have the score of the constant alone, a null doc_id is hashed as the empty text. Repeated rows
    are answered one by one; other columns are ignored. No rows give no rows.
    """
    weights = fit(docs, labels, remainder("doc_id", 3) != 1)
    return score(docs, weights, ["doc_id"]).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of the documents that score below the limit, learned from all labelled ones among them.

    Null and empty texts have the score of the constant alone; rows without doc_id are judged, but not learned from;
    repeated rows all stay or all go. Without labels everything stays. No rows give no rows.
    """
    weights = fit(docs, labels)
    return score(docs, weights, columns).where(F.col("score") < LEAST_SCORE).select(*columns)

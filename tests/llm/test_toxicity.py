"""Toxicity: accuracy on documents held out, the odd cases."""

import zlib

import math

import numpy as np
import pandas as pd
from llm_support import docs, documents  # noqa: F401

from gradeloom.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = tox.toxicity(table, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == 10000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    found = [r.predicted for r in held if r.toxic]
    wrong = [r.predicted for r in held if not r.toxic]
    # 2,600 documents to learn from, 300 of them toxic; with the whole sample it is 0.99 and 0
    assert np.mean(found) > 0.8 and np.mean(wrong) < 0.02


def test_features_once_per_document():
    import pyarrow as pa

    data, offsets = tox.flat(pa.array(["A b-a", None, "", "b a", "a  B c", "é"]))
    bucket, row = tox.once(*tox.features(data, offsets))
    assert np.bincount(row, minlength=6).tolist() == [5, 0, 0, 3, 6, 1]
    assert set(bucket[row == 3]) < set(bucket[row == 0])


def test_odd_cases(spark, docs):  # noqa: F811
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, None, 0), (None, 0, 1), (2, 0, None), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    table = docs([None, "", "x " * 50000, "x", "x"])
    assert tox.toxicity(table.unionAll(table), labels).count() == 10
    nobody = tox.toxicity(table, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in nobody} == {(0.5, 0)}
    assert tox.toxicity(docs([]), labels).count() == 0


def plain_ftrl(rows):
    """FTRL-proximal coordinate by coordinate, over dictionaries."""
    seen = {}
    for buckets, _ in rows:
        for b in buckets:
            seen[b] = seen.get(b, 0) + 1
    share = sum(t for _, t in rows) / len(rows)
    z, n = {}, {}

    def w(i, l1):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((tox.BETA + math.sqrt(n.get(i, 0.0))) / tox.ALPHA + tox.L2)

    for _ in range(tox.PASSES):
        for buckets, toxic in rows:
            own = {b: w(b, tox.L1) for b in buckets if seen[b] >= tox.LEAST_DOCS} | {-1: w(-1, 0.0)}
            g = 1 / (1 + math.exp(-sum(own.values()))) - toxic
            g *= (1 - share) / share if toxic and 0 < share < 1 else 1.0
            for i, wi in own.items():
                ni = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(ni + g * g) - math.sqrt(ni)) / tox.ALPHA * wi
                n[i] = ni + g * g
    return {i: w(i, 0.0 if i == -1 else tox.L1) for i in z if i == -1 or w(i, tox.L1) != 0}


def test_weights_and_scores_equal_plain_loops(spark, docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(tox, "L1", 1.5)
    draw = np.random.default_rng(5)
    rows = []
    for i in range(300):
        toxic = int(draw.random() < 0.3)
        rows.append((sorted(set(draw.integers(0, 40, 12).tolist()) | ({50, 51} if toxic and draw.random() < 0.8 else set())), toxic))
    part = pd.DataFrame({"at": range(300), "toxic": [t for _, t in rows], "buckets": [np.array(b, np.int32) for b, _ in rows]})
    got = tox.learn(part)
    want = plain_ftrl(rows)
    assert dict(zip(got["bucket"], np.round(got["weight"], 9))) == {k: round(v, 9) for k, v in want.items()}
    assert len(want) > 3 and want[50] > 0
    # scores: the sum of the weights of a text's different features
    texts = ["vile words here", "fine words here, fine words", None, "", "vile " * 3000]
    data, offsets = tox.flat(__import__("pyarrow").array(texts))
    bucket, row = tox.features(data, offsets)
    weights = {-1: -0.4} | {int(b): float(w) for b, w in zip(sorted(set(bucket[row == 0].tolist())), draw.normal(size=99))}
    table = docs(texts)
    for r in tox.score(table, weights, ["doc_id"]).collect():
        own = set(bucket[row == r.doc_id].tolist())
        assert math.isclose(r.score, 1 / (1 + math.exp(0.4 - sum(weights.get(b, 0.0) for b in own))), rel_tol=1e-9)


def test_null_ids_and_the_text_among_the_kept_columns(spark):
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    table = spark.createDataFrame([(None, "a b"), (1, "a b"), (2, None), (None, None)], "doc_id long, text string")
    assert {(r.doc_id, r.held_out) for r in tox.toxicity(table, labels).collect()} == {
        (None, zlib.crc32(b"") % 3 == 1), (1, zlib.crc32(b"1") % 3 == 1), (2, zlib.crc32(b"2") % 3 == 1)}
    kept = tox.without_toxic(table, labels, ["doc_id", "text"])
    assert kept.columns == ["doc_id", "text"] and kept.count() == 4

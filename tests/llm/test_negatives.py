"""Hard negatives against all scores in Python's whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import negatives as module
from gradeloom.llm.negatives import Best, Tree, between, hard_negatives, searched

SCHEMA = ("vec_id long, embedding array<double>, label int, id long, row string, own string, block string, score string, "
          "place string, part string, asks string")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, *"abcdefg") for r in rows], SCHEMA)


def plain(rows, anchor, positives=5, negatives=3):
    good = []
    for own, vector, label in rows:
        if own is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((own, [math.floor(256 * x) for x in vector], label))
    out = []
    for i, (own, vector, label) in enumerate(good):
        if not anchor(own):
            continue
        all_ = sorted((-sum(x * y for x, y in zip(vector, v)), other, mark) for j, (other, v, mark) in enumerate(good) if j != i)
        for score, positive, _ in [x for x in all_ if x[2] == label][:positives]:
            fit = [x for x in all_ if x[2] != label and 50 * -score <= 100 * -x[0] <= 95 * -score]
            out += [(own, positive, rank, other, -score, -s) for rank, (s, other, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def found(spark, rows, step, **options):
    return sorted(tuple(r) for r in hard_negatives(table(spark, rows), F.col("vec_id") % step == 0, **options).collect())


def drawn(n, dims, seed, labels=4):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((6, dims))
    return [(i, (centres[i % 6] + random.standard_normal(dims) * 0.7).tolist(), int(random.integers(labels))) for i in range(n)]


def test_many_blocks_equal_all_scores(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 3)  # about twenty blocks, of which anchors ask some
    monkeypatch.setattr(module, "ANCHORS", 0.3)
    rows = drawn(1200, 6, 1)
    assert found(spark, rows, 10) == plain(rows, lambda i: i % 10 == 0)


def test_other_counts(spark):
    rows = drawn(300, 9, 2, labels=2)
    assert found(spark, rows, 7, positives=2, negatives=6) == plain(rows, lambda i: i % 7 == 0, 2, 6)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(40)] + [(i, [0.4, 0.2], i % 3) for i in range(40)] + [(i, [0.5, 0.25], 0) for i in range(10)]
    rows += [(None, [0.5, 0.5], 1), (50, None, 1), (50, [0.5, 0.5], None), (50, [0.5, None], 1), (50, [0.5, float("nan")], 1),
             (50, [float("inf"), 0.5], 1), (60, [], 1), (60, [0.3], 2), (60, [0.0, 0.0], 0), (60, [-0.5, -0.3, 0.1], 1), (-5, [0.45, 0.22], 1),
             (70, [3e6, -2e6], 1), (75, [3e6, -2.1e6], 1), (80, [2.5e6, -2.01e6], 2)]
    assert found(spark, rows, 5) == plain([r for r in rows], lambda i: i % 5 == 0)


def test_a_third_of_all_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 2)
    rows = drawn(200, 4, 3) + [(1000 + i, [1.0, 1.0, -1.0, 0.5], i % 5) for i in range(100)]
    random.Random(4).shuffle(rows)
    assert found(spark, rows, 20) == plain(rows, lambda i: i % 20 == 0)


def test_no_rows_one_row_one_label(spark):
    assert found(spark, [], 1) == []
    assert found(spark, [(0, [1.0], 1)], 1) == []
    assert found(spark, [(i, [1.0], 1) for i in range(5)], 1) == []


@pytest.mark.parametrize("large", [1, 10**7])
def test_tree_prunes_and_bounds_hold(large):
    draw = np.random.default_rng(5)
    rows = np.floor(np.concatenate([c + draw.standard_normal((2000, 3)) for c in (draw.standard_normal((8, 3)) * 40)])) * large
    labels, ids = draw.integers(0, 3, len(rows)), draw.permutation(len(rows))
    tree = Tree(rows, ids, labels)
    anchors = np.floor(draw.standard_normal((20, 3)) * 50) * large
    below, above = between(tree.low, tree.high, anchors)
    whole = tree.rows.astype(np.int64) @ anchors.astype(np.int64).T
    for node in range(tree.leaves):
        part = whole[tree.begin[node]:tree.end[node]]
        assert (below[:, node] <= part.min(axis=0)).all() and (part.max(axis=0) <= above[:, node]).all()
    seen = []
    scores = tree.scores
    tree.scores = lambda node, *rest: seen.append(node) or scores(node, *rest)
    for i, (best,) in searched(tree, anchors, lambda i: (list(tree.roots.values()), [Best(5, -math.inf)], -1)):
        want = sorted(zip((-whole[:, i]).tolist(), tree.ids.tolist()))[:5]
        assert best.found() == [(-s, own) for s, own in want]
    assert len(seen) < 0.3 * 20 * tree.leaves

"""Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest
from llm_support import docs, documents  # noqa: F401

from gradeloom.llm import jaccard as jac


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = {d: shingle_set(t) for d, t in texts.items()}
    label = {d: d for d in sets}
    ids = sorted(sets)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            n, m = len(sets[a]), len(sets[b])
            if n and m and 4 * min(n, m) >= 3 * max(n, m):
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (n + m - both):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def check(table):
    want = brute({r.doc_id: r.text for r in table.collect()})
    rows = jac.near_groups(table).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(got) and got == want
    return want


def family(rng, words, size, changes):
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for _ in range(changes):
        own = list(base)
        for _ in range(rng.randrange(0, max(1, size // 25))):
            own[rng.randrange(size)] = rng.choice(words)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("part", [4, 1024])
def test_families_and_shared_passages(docs, monkeypatch, part):  # noqa: F811
    monkeypatch.setattr(jac, "PART", part)
    rng = random.Random(part)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts = [None, "", "  ", "a", "A", "a b", "a b c d e", "a b c d e f", "x " * 3000, "x " * 500, "é ü é ü é ü", "É ü é ü é ü"]
    for _ in range(8):
        texts += family(rng, words, rng.choice([6, 30, 100, 700]), rng.randrange(2, 12))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.choice([5, 8, 12, 14, 40]))) for _ in range(60)]
    rng.shuffle(texts)
    want = check(docs(texts, 10))
    assert len({c for _, c in want.values()}) < len(texts) - 20


def test_table(spark):
    check(documents(spark))


def test_one_of_each(docs, spark):  # noqa: F811
    table = docs(["a b c d e f", "x", None, "A b c d e f", "", "x"])
    assert sorted(r.doc_id for r in jac.one_of_each(table).collect()) == [0, 1, 2, 4]
    assert jac.one_of_each(table).columns == table.columns
    assert jac.near_groups(docs([])).count() == 0
    lone = table.selectExpr("cast(null as long) doc_id", "text")
    assert {r.component_id for r in jac.near_groups(lone).collect()} == {None}


def test_links_grow_with_a_group_of_near_copies_not_with_its_square(docs, monkeypatch):  # noqa: F811
    rng, found, verified = random.Random(11), [], jac.verified
    monkeypatch.setattr(jac, "verified", lambda *a: found.append(jac.materialize(verified(*a))) or found[-1])
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(140)]
    texts = []
    for _ in range(300):
        own = list(base)
        for _ in range(rng.randrange(2, 6)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    want = check(docs(texts, 10))
    assert len({c for _, c in want.values()}) < 200
    leaders, *trees = [f.count() for f in found]
    assert sum(trees) < 300, (leaders, trees)


def test_tree_loses_nothing():
    rng = np.random.default_rng(2)
    points = rng.poisson(3, (300, jac.COUNTS)).astype(np.int32)
    points[150:] = np.maximum(points[:150] + rng.integers(-1, 2, (150, jac.COUNTS)), 0)
    sizes = points.sum(axis=1).astype(np.int64)
    tree = jac.RTree(points, sizes)
    shared = np.minimum(points[:, None], points[None]).sum(axis=2)
    able = set(zip(*np.nonzero(shared >= jac.least_overlap(sizes[:, None], sizes[None])), strict=True))
    assert set(zip(*tree.near(points, sizes), strict=True)) == able and len(able) > 400


def test_shared_ids_and_repeated_rows(spark, monkeypatch):
    asked = []
    kept = jac.bounded
    monkeypatch.setattr(jac, "bounded", lambda pairs, sets: asked.append(sets.count()) or kept(pairs, sets))
    a, b, c, d = ("a b c d e f g h", "one two three four five six seven eight", "n " * 9, "u v w x y z u w")
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words), " ".join([*words[:-1], "other"])]
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, d), (5, None), (5, d), (None, a)] + [(100 + i, near[i % 2]) for i in range(200)]
    got = {}
    for r in jac.near_groups(spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    assert {k: got[k] for k in (None, 1, 2, 3, 4, 5)} == {None: {None}, 1: {1}, 2: {1}, 3: {1}, 4: {4}, 5: {4, 5}}
    assert all(got[i] == {100} for i in range(100, 300))
    # a row without words keeps its own id
    assert asked and max(asked) == 2  # two texts two hundred times over are two sets


def test_meetings_that_hold_no_more_pairs_are_not_visited_again(docs, monkeypatch):  # noqa: F811
    asked, pairs = {}, jac.apart_pairs
    monkeypatch.setattr(jac, "apart_pairs", lambda left, sets, few: asked.update({few: left.count()}) or pairs(left, sets, few))
    passage = [f"p{i}" for i in range(40)]
    check(docs([" ".join([f"w{i}x{j}" for j in range(70)] + passage) for i in range(3)]))
    assert asked[True] > 0 and asked[False] == 0

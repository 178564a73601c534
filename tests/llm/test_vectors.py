"""Near copies among vectors and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import vectors as vec
from gradeloom.llm.components import components
from gradeloom.llm.vectors import near_vectors

SF = "/root/testdata/sf0.1"


def brute(ids, rows):
    ok = [r is not None and len(r) > 0 and all(x is not None and np.isfinite(x) for x in r) and any(x != 0 for x in r) for r in rows]
    unit = [np.array(r, float) / np.linalg.norm(r) if o else None for r, o in zip(rows, ok, strict=True)]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i]) == len(rows[j]) and unit[i] @ unit[j] >= vec.COSINE:
                links[i].add(j)
                links[j].add(i)
    return links


def reach(links, ids):
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = min(ids[j] for j in seen)
    return out


def test_table_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    # its own rows have no near pair, so near ones are planted: three hundred, at cosines from 0.9 on
    draw, base = np.random.default_rng(8), [r.embedding for r in table.orderBy("vec_id").limit(300).collect()]
    planted = []
    for i, v in enumerate(np.array(base, float)):
        off = draw.standard_normal(len(v))
        off -= off @ v / (v @ v) * v
        cosine = draw.uniform(0.9, 0.96)
        planted.append((10**6 + i, (v / np.linalg.norm(v) * cosine + off / np.linalg.norm(off) * np.sqrt(1 - cosine**2)).tolist()))
    table = table.unionByName(spark.createDataFrame(planted, "vec_id long, embedding array<float>"))
    data = table.orderBy("vec_id").collect()
    m = np.array([r.embedding for r in data], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= vec.COSINE
    np.fill_diagonal(near, False)
    links = {i: set(np.flatnonzero(near[i]).tolist()) for i in range(len(m))}
    ids = [r.vec_id for r in data]
    want = reach(links, ids)
    rows = {r.vec_id: r for r in near_vectors(table).collect()}
    assert len(rows) == len(data)
    found = sum(r.n_links for r in rows.values())
    assert near.sum() >= 2 * 290 and 0.95 * near.sum() <= found <= near.sum()
    assert all(rows[d].n_links <= len(links[i]) for i, d in enumerate(ids))
    assert np.mean([rows[d].component_id == want[i] for i, d in enumerate(ids)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows.values())


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vec, "PART", 3)  # buckets are cut
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6, 16))
    rows = [b.tolist() for b in base]
    rows += [(base[0] + 0.01 * rng.standard_normal(16)).tolist() for _ in range(20)]
    rows += [rows[1]] * 5 + [(2 * base[1]).tolist(), None, [], [0.0] * 16, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15,
             [None] + [1.0] * 15, rows[2][:8], rows[2][:8], [1e-30] * 4, [1.0] * 4]
    ids = list(range(100, 100 + len(rows)))
    table = spark.createDataFrame(
        [(i, r, 1, "x", 2) for i, r in zip(ids, rows, strict=True)],
        "vec_id long, embedding array<double>, label int, vector string, id int")
    got = {r.vec_id: r for r in near_vectors(table).collect()}
    links = brute(ids, rows)
    want = reach(links, ids)
    assert {i: (got[d].n_links, got[d].component_id) for i, d in enumerate(ids)} == {i: (len(links[i]), want[i]) for i in range(len(ids))}


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(table).count() == 0
    nobody = spark.createDataFrame([(None, [1.0]), (None, [1.0])], "vec_id long, embedding array<float>")
    assert [(r.n_links, r.kept) for r in near_vectors(nobody).collect()] == [(0, False)] * 2


def test_components(spark):
    r = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    pairs = chain + [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(5000, 5000 + i) for i in range(50)]
    got = {x.node: x.component for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    links = {}
    for a, b in pairs:
        if a != b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    want = reach(links, {i: i for i in links})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("count", [5_000, 200_000, 2_000_000, 20_000_000])
def test_pairs_near_the_threshold_are_found_at_every_count(spark, monkeypatch, count):
    real = vec.shape
    monkeypatch.setattr(vec, "shape", lambda _: real(count))
    rng = np.random.default_rng(8)
    cosine = np.repeat([0.901, 0.92, 0.95], 200)
    a, b = vec.unit(rng.standard_normal((600, 64))), rng.standard_normal((600, 64))
    b = vec.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = cosine[:, None] * a + np.sqrt(1 - cosine ** 2)[:, None] * b
    rows = [(i, r.tolist()) for i, r in enumerate(np.concatenate([a, b]))]
    found = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    got = np.array([found[i].n_links == 1 and found[i + 600].component_id == i for i in range(600)]).reshape(3, 200).mean(axis=1)
    print(count, real(count), got)
    assert (got >= 0.9).all(), got


def test_very_large_and_small_doubles(spark):
    base = [0.3, -0.2, 0.9, 0.1]
    rows = [(i, [x * scale for x in base]) for i, scale in enumerate((1.0, 1e200, 1e-200, 1e305, 1e-300))] + [(9, [1e200, 1e200, 1e-200, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**{i: (4, 0) for i in range(5)}, 9: (0, 9)}


def test_components_of_few_links_go_on_in_few_partitions(spark):
    pairs = spark.range(0, 500, numPartitions=4).select(F.col("id").alias("a"), (F.col("id") + 500).alias("b"))
    wide = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    try:
        for k, v in wide.items():
            spark.conf.set(k, v)
        got = components(pairs)
        assert got.rdd.getNumPartitions() < 10
        assert {r.node: r.component for r in got.collect()} == {i: i % 500 for i in range(1000)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

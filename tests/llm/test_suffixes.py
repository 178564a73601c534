"""Removal of repeated bytes against brute force; the merge against sorting."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_support import docs, documents  # noqa: F401

from gradeloom.llm import suffixes as suf


def brute(rows):
    """Rows (doc_id, text) to (bytes, removed, spans, digest), in the order given."""
    data = [(d, (t or "").encode()) for d, t in rows]
    first = defaultdict(lambda: float("inf"))
    for d, b in data:
        if d is not None:
            for i in range(len(b) - 49):
                first[b[i:i + 50]] = min(first[b[i:i + 50]], d)
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 2, bool)
        if d is not None:
            for i in range(len(b) - 49):
                if first[b[i:i + 50]] < d:
                    gone[i + 1:i + 51] = True
        inner = gone[1:-1]
        out.append((d, len(b), int(inner.sum()), int((np.diff(gone.astype(int)) == 1).sum()),
                    hashlib.sha256(bytes(x for x, g in zip(b, inner, strict=True) if not g)).hexdigest()))
    return out


def check(table):
    want = brute([(r.doc_id, r.text) for r in table.collect()])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suf.without_repeats(table).collect()]
    key = lambda x: (x[0] is None, *map(str, x))
    assert sorted(got, key=key) == sorted(want, key=key)
    return want


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 24), (2, 2000)])
def test_families(spark, docs, monkeypatch, seed, chunk):  # noqa: F811
    monkeypatch.setattr(suf, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suf, "BLOCK", 1000 if seed == 2 else 1 << 20)
    r = random.Random(seed)
    letters = "abcdefgh é\x00"
    make = lambda n: "".join(r.choice(letters) for _ in range(n))
    passages = [make(n) for n in (48, 49, 50, 51, 90, 300)]
    texts = [None, "", "a" * 49, "a" * 50, "a" * 51, "a" * 400, "ab" * 300, "ba" * 100, "\x00" * 120, "\x00" * 60]
    base = make(700)
    for _ in range(12):
        own = list(base)
        for _ in range(r.randrange(6)):
            own[r.randrange(len(own))] = r.choice(letters)
        texts.append("".join(own))
    texts += [make(r.randrange(90)) + r.choice(passages) + make(r.randrange(90)) + r.choice(passages) for _ in range(50)]
    r.shuffle(texts)
    want = check(docs(texts))
    assert sum(x[2] for x in want) > 3000
    table = docs(texts[:20]).unionAll(docs(texts[:20])).unionAll(docs(texts[:9]).selectExpr(
        "cast(null as long) doc_id", "text", "lang", "source", "n_chars", "row", "words", "hash", "size"))
    check(table.orderBy("text"))


def test_table(spark):
    check(documents(spark))


def test_no_rows(docs):  # noqa: F811
    assert suf.without_repeats(docs([])).count() == 0


def test_loser_tree():
    r = random.Random(9)
    for count in (1, 2, 3, 7, 16):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(12)) for _ in range(r.randrange(40))) for _ in range(count)]
        runs = [sorted(set(x)) for x in runs]
        lcp = lambda a, b: next((i for i in range(12) if a[i] != b[i]), 12)
        source, prefix = suf.merge(runs, [[0] + [lcp(a, b) for a, b in zip(x, x[1:], strict=False)] for x in runs])
        left = [list(x) for x in runs]
        merged = [left[s].pop(0) for s in source]
        assert merged == sorted(x for run in runs for x in run)
        assert prefix[1:] == [lcp(a, b) for a, b in zip(merged, merged[1:], strict=False)]


def test_front_coding():
    rng = np.random.default_rng(1)
    rows = np.unique(rng.integers(0, 2, (200, suf.WIDTH)).astype(np.uint8), axis=0)
    same = suf.common(rows)
    assert (suf.front_decoded(same, rows[np.arange(suf.WIDTH) >= same[:, None]]) == rows).all()


def test_steps():
    rows = np.random.default_rng(2).integers(0, 2, (50, suf.PLACES)) * suf.NEVER
    assert (suf.unsteps(suf.steps(rows)) == rows).all()


def test_a_frequent_suffix_is_sent_once_a_chunk(docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(suf, "PLACES_AT_ONCE", 100)
    r = random.Random(3)
    passage = "".join(r.choice("abcdefgh ") for _ in range(120))
    table = docs(["=" * 5000, "ab" * 2000, *(f"{i} {passage} {i}" for i in range(300)), "=" * 4000, "ab" * 2500])
    check(table)
    body = suf.chunks(table.selectExpr("doc_id", "text").coalesce(1)).first().body
    chunk = suf.Chunk(bytes(body))
    key, _ = suf.keyed(chunk.suffixes()[3], 1)
    at, rows, _, _ = chunk.shared([{"part": 0, "bits": np.packbits(np.ones(len(key), bool)).tobytes()}], 1)
    assert len(at) > 9000 and len(rows) < len(at) / 8

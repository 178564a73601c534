"""Phrases against a plain count in Python."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_support import documents

from gradeloom.llm.collocations import SLICE, collocations, merged_stripes, packed, score

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, subsumed=50, top=2000):
    """The same by strings, a dictionary and loops."""
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            counts.update((lang, tuple(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    gone = {(lang, words[i:i + 2]) for (lang, words), a in candidates.items() if len(words) == 3 for i in (0, 1)
            if 100 * a >= subsumed * candidates[lang, words[i:i + 2]]}
    rated = []
    for (lang, words), a in candidates.items():
        if (lang, words) not in gone:
            cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            rated.append((lang, -score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rated):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


def found(df, **options):
    return sorted(tuple(r) for r in collocations(df, **options).collect())


SCHEMA = "doc_id long, text string, lang string, first long, n long, part string, word string, pair string, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, 1, 1, "x", "y", "z", "u") for i, (lang, text) in enumerate(rows)], SCHEMA)


def test_given_documents_with_several_limits(spark):
    df = documents(spark)
    rows = [(r.lang, r.text) for r in df.collect()]
    assert found(df) == plain(rows)
    assert found(df, least=3, subsumed=80, top=50) == plain(rows, 3, 80, 50)


def test_nulls_empties_ties_and_repeats(spark):
    rows = [
        (None, "New York City is new york city. NEW york,city\tnew  york"), ("und", "new york\ncity"), ("en", None), ("en", ""),
        ("en", " \t.,;"), ("de", "en en en en"), ("en", "de de de de"), ("en", "İstanbul'da   été\u000bété\x00 été"), (None, None),
    ] + [("en", "a b c d. d c b a, a b"), ("fr", "x y. x y. y x. y x")] * 6
    for least in (1, 2, 5):
        assert found(table(spark, rows), least=least) == plain(rows, least)
    assert found(table(spark, rows).repartition(5), least=2, top=3) == plain(rows, 2, 50, 3)


def test_no_rows_and_no_words(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [("en", None), (None, " .")])) == []
    assert found(table(spark, [("en", "a")]), least=1) == []


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_chunks_parts_and_common_pairs_change_nothing(spark, chunk):
    # every pair seen twice in a chunk counts as common, so stripes are split by their third words and summed
    rows = [("en", "of the " + w + " and of the. the of " + w) for w in "one two three four one two one".split() * 5]
    rows += [("de", "w" * 5000 + " of the " * 300)]
    assert found(table(spark, rows), least=4, chunk=chunk, part=40, share=1e-9) == plain(rows, 4)
    assert found(table(spark, rows), least=4, chunk=chunk, part=40, share=0.05) == plain(rows, 4)


def test_a_part_is_merged_in_little_memory():
    """Some chunks' stripes of one part, several slices in all, against a dictionary."""
    draw, rows, plain_counts = np.random.default_rng(3), [], Counter()
    everything = np.sort(draw.integers(1, 2**63, 3000).astype(np.uint64))
    for _ in range(12):
        own = np.sort(draw.choice(everything, 2000, replace=False))
        key = np.unique(draw.integers(0, 300 * 40 * 41, 100_000))
        a, b, c = key // (40 * 41) + 1, key // 41 % 40 + 1, key % 41  # 0: no third word
        n = draw.integers(1, 4, len(key))
        rows.append((0, own.tobytes(), packed(np.diff(a, prepend=0), b, c, n)))
        ids = np.concatenate([[0], own.view(np.int64)])
        plain_counts.update({(x, y, z or None): k for x, y, z, k in zip(ids[a].tolist(), ids[b].tolist(), ids[c].tolist(), n.tolist())})
    table = pa.table({"part": pa.array([r[0] for r in rows]), "words": pa.array([r[1] for r in rows], pa.binary()),
                      "counters": pa.array([r[2] for r in rows], pa.binary())})
    counters = len(plain_counts)
    tracemalloc.start()
    got = merged_stripes(10, np.zeros(0, np.uint64))(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counters > 3 * SLICE
    assert peak < 90 * counters
    total, best = Counter(), Counter()
    for (x, y, z), k in plain_counts.items():
        total[x, y] += k
        best[x, y] = max(best[x, y], k if z is not None else 0)
    want = {(x, y, None, k, k, best[x, y], False) for (x, y), k in total.items() if k >= 10}
    want |= {(*key, k, total[key[:2]], best[key[:2]], False) for key, k in plain_counts.items() if k >= 10 and key[2] is not None}
    assert set(map(tuple, (r.values() for r in got.to_pylist()))) == want and got.num_rows == len(want)


def test_scores_pass_64_bits(spark):
    counts = [(a, a + 3, 10**15) for a in (10, 3_100_000, 10**12, 10**15 - 7)]
    df = spark.createDataFrame(counts, "a long, l long, r long").withColumn("score", score("a", "l", "r"))
    assert [r.score for r in df.orderBy("a").collect()] == [10**6 * a * a // (x * y) for a, x, y in counts]

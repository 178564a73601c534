"""Language-model scores: counts against brute force, the model against a plain loop, its gradient, its use."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_support import docs, documents  # noqa: F401

from gradeloom.llm import lm
from gradeloom.llm.toxicity import remainder

PATH = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scores(table):
    return lm.language_scores(table, PATH, remainder("doc_id", 5) == 1).collect()


def check(table):
    texts = {r.doc_id: words(r.text) for r in table.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in [*t, None])
    n, v = sum(c.values()), len(c)
    rows = scores(table)
    assert len(rows) == len(texts)
    for r in rows:
        t = [*texts[r.doc_id], None]
        assert r.held_out == held[r.doc_id] and r.n_tokens == len(t) and r.train_tokens == n
        assert r.n_known == sum(c[w] > 0 for w in t)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


@pytest.mark.parametrize("frequent", [3, 1 << 19])
def test_odd_texts(docs, monkeypatch, frequent):  # noqa: F811
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    texts = [None, "", " \t", "A a a É é", "x " * 20000, "y" * 5000, "a b", "a b", *("w%d a" % i for i in range(30))]
    check(docs(texts))


def test_table(spark):
    check(documents(spark))


def test_nothing_to_learn_from(docs):  # noqa: F811
    table = docs(["a b", None])
    rows = lm.language_scores(table, PATH, remainder("doc_id", 5) >= 0).collect()
    assert {(r.n_known, r.train_tokens, r.held_out) for r in rows} == {(0, 0, True)}
    assert lm.language_scores(docs([]), PATH, remainder("doc_id", 5) == 1).count() == 0


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """Several shards, averaged in two steps, from one and from eight partitions and with rows repeated."""
    monkeypatch.setattr(lm, "SHARD", 3_000)
    monkeypatch.setattr(lm, "FAN", 4)
    table = documents(spark).select("doc_id", "text")
    own = {r.doc_id: r for r in scores(table.coalesce(1))}
    for r in scores(table.repartition(8)):
        assert math.isclose(r.score, own[r.doc_id].score, rel_tol=1e-5) and r.n_known == own[r.doc_id].n_known


def test_repeated_rows_of_a_shared_id(spark):
    """Each row has its line; equal rows have equal scores, rows that only share an id have their own."""
    rows = [(7, "red green blue " * 20)] * 300 + [(7, "other words here"), (None, "red"), (None, None), (9, "")]
    got = scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert len(got) == len(rows)
    assert {r.n_tokens: sum(x.n_tokens == r.n_tokens for x in got) for r in got} == {61: 300, 4: 1, 2: 1, 1: 2}
    assert max(r.score for r in got if r.n_tokens == 61) - min(r.score for r in got if r.n_tokens == 61) < 1e-3


def test_batch_gradient_is_that_of_the_whole_batch(monkeypatch):
    monkeypatch.setattr(lm, "LEARNED", 3)
    rng, w = np.random.default_rng(8), lm.start_weights(4)
    x, y = rng.integers(0, lm.ROWS, (10, lm.CONTEXT)), rng.integers(0, lm.CLASSES, (10, lm.CONTEXT))
    there = rng.random((10, 1)) * lm.CONTEXT < np.arange(1, lm.CONTEXT + 1)
    whole = lm.gradients(w, x, y, there)[1]
    for name, g in lm.batch_gradient(w, x, y, there).items():
        assert np.allclose(g, whole[name], atol=1e-6), name


def test_windows_score_each_input_once():
    counts = np.array([1, 16, 17, 100, 31, 32, 33])
    at, there, scored = lm.windows(counts)
    assert sorted(at[scored].tolist()) == list(range(counts.sum()))
    assert (there.sum(axis=1) >= scored.sum(axis=1)).all() and not (scored & ~there).any()


def test_batched_scores_equal_a_plain_loop():
    rng = np.random.default_rng(5)
    w = lm.start_weights(3)
    w["far"] = rng.standard_normal(lm.CONTEXT).astype(np.float32)
    counts = np.array([1, 5, 40, 70])
    into, class_ = rng.integers(0, lm.ROWS, counts.sum()), rng.integers(0, lm.CLASSES, counts.sum())
    got = lm.Scorer(w)(into, class_, np.zeros(counts.sum(), np.float32), counts)
    first = 0
    for n, score in zip(counts.tolist(), got, strict=True):
        total = 0.0
        for i in range(n):
            low = max(0, i // lm.STRIDE * lm.STRIDE - (lm.CONTEXT - lm.STRIDE))
            e = w["e"][into[first + low:first + i + 1]].astype(float)
            s = e @ w["k"] @ (e[-1] @ w["q"]) / math.sqrt(lm.WIDTH) + w["far"][np.arange(len(e))[::-1]]
            a = np.exp(s) / np.exp(s).sum()
            h = np.tanh(a @ (e @ w["v"]) + e[-1] @ w["r"] + w["b"])
            group, member = divmod(int(class_[first + i]), lm.MEMBERS)
            for z, c in ((h @ w["u"] + w["c"], group), (h @ w["m"][group] + w["d"][group], member)):
                total += z[c] - np.log(np.exp(z).sum())
        assert math.isclose(score, total / math.log(10), rel_tol=1e-4)
        first += n


def test_gradient():
    rng = np.random.default_rng(6)
    w = {k: v.astype(np.float64) for k, v in lm.start_weights(2).items()}
    x, y = rng.integers(0, 9, (3, lm.CONTEXT)), rng.integers(0, lm.CLASSES, (3, lm.CONTEXT))
    there = np.ones((3, lm.CONTEXT), bool)
    there[0, :10] = there[1, 20:] = False
    _, g = lm.gradients(w, x, y, there)
    for name, value in w.items():
        for place in zip(*(rng.integers(0, s if name != "e" or i else 9, 4) for i, s in enumerate(value.shape)), strict=True):
            step = 1e-5
            keep = value[place]
            value[place] = keep + step
            up, _ = lm.gradients(w, x, y, there)
            value[place] = keep - step
            down, _ = lm.gradients(w, x, y, there)
            value[place] = keep
            assert math.isclose((up - down) / (2 * step), g[name][place], rel_tol=2e-2, abs_tol=2e-5), name


def test_order_of_words_matters(spark, docs):  # noqa: F811
    """Held-out text in its own order is likelier than with its letters' parts mixed."""
    table = documents(spark)
    own = {r.doc_id: r for r in scores(table)}
    rng = random.Random(1)
    mixed = {}
    for r in table.collect():
        t = re.findall(r"\w{1,3}|\W", r.text)
        rng.shuffle(t)
        mixed[r.doc_id] = "".join(t)
    both = table.collect()
    held = [r.doc_id for r in both if own[r.doc_id].held_out and len(r.text) > 300]
    spare = spark.createDataFrame([(d, mixed[d]) if d in held else (d, r.text) for d, r in ((r.doc_id, r) for r in both)], "doc_id long, text string")
    other = {r.doc_id: r for r in scores(spare)}
    assert np.mean([own[d].score > other[d].score for d in held]) > 0.9


def test_texts_are_cut_into_subwords_once(spark):
    """What learns and what scores gets the ids that were written, not the texts."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    texts = {1: "Red, green (blue) été 12ab", 2: None, 3: "", 4: "red  green\nblue " * 50}
    table = spark.createDataFrame(list(texts.items()), "key long, text string").withColumn("held_out", F.lit(False))
    known = lm.encoded(table, PATH)
    plain = Tokenizer.from_file(PATH)
    want = {k: plain.encode(t or "", add_special_tokens=False).ids for k, t in texts.items()}
    rows = {r.key: r for r in known.collect()}
    assert {k: np.frombuffer(r.ids, np.uint16).tolist() for k, r in rows.items()} == want
    assert {k: r.size for k, r in rows.items()} == {k: len((t or "").encode()) for k, t in texts.items()}
    counts = {r.id: r.n for r in lm.counted_ids(known).collect()}
    assert counts == {**Counter(i for x in want.values() for i in x), -1: 4}
    ids = np.zeros(lm.VOCABULARY)
    ids[[i for i in counts if i >= 0]] = [n for i, n in counts.items() if i >= 0]
    w = lm.start_weights()
    learned = lm.learned_from_all(known, w, lm.Vocabulary.of(ids), int(ids.sum()) + 4)
    assert any((learned[k] != w[k]).any() for k in w)


def test_gradient_without_loss_and_windows_of_some():
    rng, w = np.random.default_rng(9), lm.start_weights(4)
    x, y = rng.integers(0, lm.ROWS, (6, lm.CONTEXT)), rng.integers(0, lm.CLASSES, (6, lm.CONTEXT))
    there = rng.random((6, 1)) * lm.CONTEXT < np.arange(1, lm.CONTEXT + 1)
    (loss, g), (none, same) = lm.gradients(w, x, y, there), lm.gradients(w, x, y, there, with_loss=False)
    assert loss > 0 and none is None and all((g[k] == same[k]).all() for k in g)
    counts = np.array([1, 16, 17, 100, 31, 32, 33])
    chosen = rng.permutation(lm.covering(counts))
    assert all((some == all_[chosen]).all() for some, all_ in zip(lm.windows(counts, chosen), lm.windows(counts), strict=True))


def test_places_of_hashes():
    rng = np.random.default_rng(10)
    for n in (0, 1, 5, 3000):
        known = np.unique(np.append(rng.integers(0, 2**64, n, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)[:n]))
        word = np.concatenate([known, rng.integers(0, 2**64, 1000, dtype=np.uint64), known[1:] - np.uint64(1)])
        assert (lm.Places(known)(word) == np.searchsorted(known, word)).all()


def test_weights_see_every_input():
    counts = np.array([1, 15, 16, 17, 31, 32, 33, 100, 1])
    at, there, _ = lm.windows(counts)
    chosen = lm.covering(counts)
    assert set(at[chosen][there[chosen]].tolist()) == set(range(counts.sum()))


def test_documents_beyond_the_sample_teach_the_model(docs, monkeypatch):  # noqa: F811
    """Scores of a held-out text rise with the documents that resemble it, all of them outside the sample."""
    monkeypatch.setattr(lm, "SAMPLE", 4)
    held = next(i for i in range(10 ** 6, 10 ** 6 + 100) if zlib.crc32(str(i).encode()) % 5 == 1)
    rng = random.Random(2)
    bag = [w for _ in range(300) for w in ("red", "green", "blue", "house", "river", "stone")]
    fixed = "red green blue house river stone " * 10
    texts = lambda own: [own if i % 2 else " ".join(rng.sample(bag, 60)) for i in range(600)]
    mixed = " ".join(rng.sample(fixed.split(), 60))
    score = {}
    # the same counts of ids either way: only the order of words in the documents differs
    for name, own in (("same", fixed), ("other", mixed)):
        table = docs(texts(own)).unionByName(docs([fixed], held))
        score[name] = {r.doc_id: r.score for r in scores(table)}[held]
    assert score["same"] > score["other"] + 5, score

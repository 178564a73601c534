"""Personal data, licenses and decontamination against brute force."""

import hashlib
import re

import pytest

from llm_support import SF, docs, documents  # noqa: F401
from gradeloom.llm.decontaminate import candidates, contained_items, item_table, without_items
from gradeloom.llm.licenses import NOTICES, PHRASES, license_labels
from gradeloom.llm.pii import personal_data_digest

ODD = [
    None, "", " ", "a@b.co_x@d.e.f and x@y", "...@x.y", "a" * 3000 + "@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.255",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111-", "+1 (377) 555-0271 tiha +49 30 12", "++1 2 3",
    "IBAN DE89 3704 0044 0532 0130 00 konto", "ssn 123-45-6789; 123-45-6789", "ü𝄞 me@x.org 😀 1.2.3.4", "1 " * 5000,
    "Licensed under nothing else", "under the", "cc by", "CC BY-NC all rights reserved. All Rights\nReserved", "cc  -- by ccby", "general public general public license",
    "Licensed under the very Apache License, Version 2.0", "K cc by İ", "x " * 20000, "1.2." * 400, "a.b@c." * 400,
]


def spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19:
            s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
            if s % 10 == 0:
                out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


@pytest.mark.parametrize("source", ["odd", "table"])
def test_personal_data(spark, docs, source):
    table = docs(ODD + ODD) if source == "odd" else documents(spark)
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    rows = personal_data_digest(table).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = spans(texts[r.doc_id])
        flat = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(flat.encode()).hexdigest(), (texts[r.doc_id][:80], want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in want) for k in ("email", "ip", "card", "phone")]
        assert r.spans.startswith(flat)


def test_confirmed_spans_of_other_kinds(docs):
    rows = {r.doc_id: r for r in personal_data_digest(docs(
        ["IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE89 3704 0044 0532 0130 01.", "my ssn 123-45-6789", "part 123-45-6789"])).collect()}
    assert [("iban" in rows[0].spans), ("iban" in rows[1].spans), ("ssn" in rows[2].spans), ("ssn" in rows[3].spans)] == [True, False, True, False]


def test_account_numbers_before_other_words(docs):
    short, long_ = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    texts = [f"IBAN {short} BIC COBADEFFXXX", f"IBAN: {long_} EUR 500", f"{long_} {short}", f"REF AB12 {short} GB82 WEST 1234 5698 7654 32 X",
             f"IBAN {short}0", "IBAN NO93 8601 1117 947 KID 123"]
    want = [[short], [long_], [long_, short], [short, "GB82 WEST 1234 5698 7654 32"], [], ["NO93 8601 1117 947"]]
    for r in personal_data_digest(docs(texts)).collect():
        got = [s.split(":") for s in r.spans.split(",") if s.startswith("iban")]
        assert [texts[r.doc_id][int(a):int(b)] for _, a, b in got] == want[r.doc_id], (r, texts[r.doc_id])


@pytest.mark.parametrize("source", ["odd", "table"])
def test_licenses(spark, docs, source):
    table = docs(ODD + ODD) if source == "odd" else documents(spark)
    texts = {r.doc_id: r.text for r in table.collect()}
    rows = license_labels(table).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = split(texts[r.doc_id])
        hits = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        assert r.n_words == len(w) and r.n_base == len(hits), (texts[r.doc_id], r)
        assert r.first_word == min((i for i, _ in hits), default=None)
        assert r.last_word == max((i for i, _ in hits), default=None)
        base = sorted({label for _, label in hits})
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_changed_notices_are_found(docs):
    texts = [t.replace(" the ", " the said ", 1) for ts in NOTICES.values() for t in ts if " the " in t]
    labels = [k for k, ts in NOTICES.items() for t in ts if " the " in t]
    rows = {r.doc_id: r.labels.split(",") for r in license_labels(docs(["lorem ipsum. " + t + " dolor" for t in texts])).collect()}
    assert all(label in rows[i] for i, label in enumerate(labels))


def test_empty_tables(spark, docs):
    none = docs([])
    assert personal_data_digest(none).count() == license_labels(none).count() == 0
    assert contained_items(none, items(spark, ["a b c d e f"])).count() == 0
    assert contained_items(docs(["a b c d e f"]), items(spark, [])).count() == 0


def items(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def runs(text):
    w = split(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def check_items(texts, item_texts, rows):
    want = {}
    for d, t in texts.items():
        for i, it in item_texts.items():
            s, k = runs(it), len(split(it)) if it else 0
            w = split(t) if t else []
            own = runs(t) if k >= 5 else {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
            if s and 100 * len(s & own) >= 75 * len(s):
                want[d, i] = (len(s), len(s & own))
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in rows} == want
    assert len(rows) == len(want)
    return want


def test_contained_items_in_odd_texts(spark, docs):
    passage = " ".join(f"w{i}" for i in range(30))
    cut = " ".join(f"w{i}" for i in range(24))
    texts = ["x " * 9000 + passage.upper() + " y" * 9000, cut, " ".join(f"w{i}" for i in range(22)), None, "", "one two", "One, two!", passage, passage]
    its = [passage, "one two", None, "", passage, "a b c d e"]
    table, bench = docs(texts), items(spark, its)
    want = check_items(dict(enumerate(texts)), dict(enumerate(its)), contained_items(table, bench).collect())
    assert (0, 0) in want and (1, 0) in want and (2, 0) not in want
    assert {r.doc_id for r in without_items(table, bench).collect()} == {2, 3, 4}


def test_contained_items_of_the_table(spark):
    table, bench = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = check_items({r.doc_id: r.text for r in table.collect()}, {r.item_id: r.text for r in bench.collect()},
                       contained_items(table, bench).collect())
    assert want


def test_only_sketches_propose_pairs(spark, docs):
    passage = [f"w{i}" for i in range(60)]
    bench = items(spark, [" ".join(passage), "one two"])
    table = item_table(bench)
    marked = {tuple(r[f"i{j}"] for j in range(5)) for r in table.where("sketch").collect()}
    assert 0 < len(marked) < table.count()
    texts = [" ".join(passage[i:i + 5]) for i in range(56)] + ["one two", "one two three four five", " ".join(passage)]
    got = {(r.c_doc, r.c_item) for r in candidates(docs(texts), table, [2]).collect()}
    assert got == {(i, 0) for i in range(56) if tuple(passage[i:i + 5]) in marked} | {(56, 1), (57, 1), (58, 0)}
    assert {(r.doc_id, r.item_id) for r in contained_items(docs(texts), bench).collect()} == {(56, 1), (57, 1), (58, 0)}


def test_short_items_inside_long_texts(spark, docs):
    filler = " ".join(f"f{i}" for i in range(3000))
    its = ["Paris is nice", "zig zag", "alone", "a b c d", "one two three four five", "", "Paris is nice"]
    texts = ["so they say paris is nice and more words here", filler + " Zig, zag! " + filler, "paris is very nice", "alone", "not alone here",
             "a b c d", "x a b c d y", "a b c", "a b x c d", "zig", None, "", "one two three four", "zag zig zag zig"]
    table, bench = docs(texts), items(spark, its)
    want = check_items(dict(enumerate(texts)), dict(enumerate(its)), contained_items(table, bench).collect())
    assert {(0, 0), (0, 6), (1, 1), (3, 2), (4, 2), (5, 3), (6, 3), (13, 1)} == set(want)
    con = __import__("duckdb").connect()
    con.register("documents", table.select("doc_id", "text").toPandas())
    con.register("benchmark", bench.toPandas())
    from gradeloom.llm.sql import CONTAINED
    assert {r[:2] for r in con.execute(f"select doc_id, item_id from ({CONTAINED})").fetchall()} == set(want)

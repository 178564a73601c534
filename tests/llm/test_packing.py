"""Packing: exact pieces, whole sequences, few of them."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from llm_support import docs, documents  # noqa: F401
from tokenizers import Tokenizer

from gradeloom.llm import packing
from gradeloom.llm.packing import pack, place

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n", "<|startoftext|> a <|ENDOFTEXT|>", "don't x.'t ǅ K a≠b  x y Σας ΣΑΣ.", "é,ß.,!? 12.5% 'll 're",
       "á é Å ́b", "a\x00b\x1cc\x85d", "ﬁ ½ ² Ⅳ 漢字かな한국어", "w " * 2047, "w " * 2048, "w " * 6143, "w " * 100000, "x" * 30000]


def check(table, limit):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0] for r in table.collect()}
    rows = pack(table, PATH, limit, with_ids=True).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    assert set(by) == set(ids)
    for doc, parts in by.items():
        parts.sort(key=lambda r: r.piece)
        assert [i for r in parts for i in r.ids] == ids[doc]
        assert [(r.piece, r.start) for r in parts] == [(i, i * limit) for i in range(len(parts))]
        assert len(parts) == -(-len(ids[doc]) // limit)
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert sum(n for _, n in spans) <= limit
    return len(sequences), sum(map(len, ids.values())) / limit


def test_odd_texts(docs):  # noqa: F811
    check(docs(ODD + ODD), 2048)
    check(docs(ODD), 7)


def test_table_is_packed_well(spark):
    made, least = check(documents(spark), 2048)
    assert made <= least * 1.02 + 1


def test_placing_is_the_best_by_squares():
    rng = np.random.default_rng(3)
    for _ in range(30):
        limit = int(rng.integers(3, 12))
        lengths = rng.integers(1, limit + 1, 40)
        sequence, offset = place(lengths, limit)
        gaps = {}
        for size, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
            def squares(choice):
                left = [g for k, g in gaps.items() if k != choice] + [gaps[choice] - size]
                return sum(left.count(g) ** 2 for g in set(left) if g)
            fits = {k: squares(k) for k, g in gaps.items() if g >= size}
            if s in gaps:
                assert fits[s] == min(fits.values()) and o == limit - gaps[s]
            else:
                assert not fits and o == 0
            gaps[s] = gaps.get(s, limit) - size


def test_no_rows(docs):  # noqa: F811
    assert pack(docs([]), PATH).count() == 0


def test_blocks_hold_no_full_pieces(docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(packing, "BLOCK_ROWS", 5)
    table = docs(["w " * 2047, "w " * 60000, *("w " * (i + 3000) for i in range(20))])
    check(table, 2048)
    rows = pack(table, PATH).collect()
    blocks = Counter(r.sequence_id >> 32 for r in rows if r.sequence_id < packing.FULL)
    assert all((r.length == 2048) == (r.sequence_id >= packing.FULL) for r in rows)
    assert sum(blocks.values()) == 21 and len(blocks) > 1
    full = [r.sequence_id for r in rows if r.length == 2048]
    assert len(set(full)) == len(full) == sum(r.length == 2048 for r in rows)

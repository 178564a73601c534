"""Subword ids of whole texts by a public tokenizer, each different word encoded once per worker."""

from __future__ import annotations

import os
import re

import numpy as np

from gradeloom.llm.bytetext import LOWERED, SPACE, groups, hashes, runs

#: Slots of the cache of words (16 bytes each), and ids kept for them (2 bytes each).
SLOTS, POOL = 1 << 21, 1 << 24

ALNUM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    ALNUM[_a:_b] = True
MARK = np.zeros(256, bool)
MARK[0x21:0x7F] = True
MARK &= ~ALNUM
#: Kinds of bytes for `bytes.translate`: 0 white space, 1 a letter or digit, 2 a mark, 3 any other.
KIND = np.select([SPACE, ALNUM, MARK], [0, 1, 2], 3).astype(np.uint8).tobytes()
#: Words of these letters are one unit for the tokenizer and need no normalising.
PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


class Subwords:
    """The tokenizer word_bpe_49k, which lower-cases and drops white space.

    It never looks across white space, and never from an ASCII letter or digit to an ASCII mark behind it. So
    a text's ids are those of its parts between these places, one after the other, and parts repeat. The few
    texts that hold a special token's string are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [str(t.content).encode() for t in special]
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(SLOTS, np.uint64)
        self.start = np.zeros(SLOTS, np.int32)
        self.length = np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint16), 0

    def keep(self, lists: list[list[int]]) -> np.ndarray:
        """Put ids behind those in the pool; where each list starts."""
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(lengths.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + total] = np.fromiter((i for x in lists for i in x), np.uint16, total)
        starts = self.used + np.cumsum(lengths) - lengths
        self.used += total
        return starts

    def pieces(self, texts: list[str]) -> list[list[int]]:
        """Ids of each word; plain words go straight to the tokenizer's model."""
        model, out, rest = self.tokenizer.model, [], []
        for i, text in enumerate(map(str.lower, texts)):
            if PLAIN(text):
                out.append([x.id for x in model.tokenize(text if text.isascii() else text.translate(self.letters))])
            else:
                out.append([])
                rest.append(i)
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after the other, and their number by row. Takes one group of rows."""
        rows = len(offsets) - 1
        raw = data.tobytes()
        if any(token in raw for token in self.special):
            lists = [x.ids for x in self.tokenizer.encode_batch_fast(
                [raw[offsets[i]:offsets[i + 1]].decode() for i in range(rows)], add_special_tokens=False)]
            return np.fromiter((i for x in lists for i in x), np.uint16), np.fromiter(map(len, lists), np.int64, rows)
        if self.used > POOL:
            self.forget()
        low, kind = np.frombuffer(raw.translate(LOWERED), np.uint8), np.frombuffer(raw.translate(KIND), np.uint8)
        marks = np.flatnonzero((kind[1:] == 2) & (kind[:-1] == 1)) + 1
        starts, ends = runs(kind != 0, np.concatenate([marks, offsets[1:-1]]))
        word = hashes(low, starts, ends)[0]
        slot = (word >> np.uint64(64 - 21)).astype(np.int64)
        hit = (self.key[slot] == word) & (self.length[slot] > 0)
        at, length = self.start[slot], self.length[slot]
        if not hit.all():
            missed = np.flatnonzero(~hit)
            new, first, back = np.unique(word[missed], return_index=True, return_inverse=True)
            a, b = starts[missed[first]], ends[missed[first]]
            small = low.tobytes()
            texts = [small[x:y].decode() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            lists = self.pieces(texts)
            place = self.keep(lists)
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            at[missed], length[missed] = place[back], size[back]
            slot = (new >> np.uint64(64 - 21)).astype(np.int64)
            self.key[slot], self.start[slot], self.length[slot] = new, place, size
        ends_ = np.cumsum(length, dtype=np.int64)
        total = int(ends_[-1]) if len(ends_) else 0
        where = np.repeat(at - (ends_ - length), length) + np.arange(total)
        row = np.searchsorted(offsets[1:], starts, side="right")
        return self.pool[where], np.bincount(row, weights=length, minlength=rows).astype(np.int64)


_loaded: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """The tokenizer of this worker process."""
    if path not in _loaded:
        _loaded[path] = Subwords(path)
    return _loaded[path]


__all__ = ["Subwords", "groups", "subwords"]

"""Phrases of two and three words that keep together: stripes of next words, merged element by element."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.bytetext import LOWER, STEP, flat, groups, hashes, mix, runs
from gradeloom.llm.grouped import bounds
from gradeloom.llm.shipping import ship
from gradeloom.session import materialize, shuffle_width

LEAST = 10
#: A phrase goes if a longer candidate holds it in at least so many of a hundred places.
SUBSUMED = 50
TOP = 2000
#: Bytes of text counted at a time, and words whose stripes are merged in one part.
CHUNK, PART = 1 << 22, 2_500_000
#: Counters of a part merged at a time, about, so that temporary arrays stay small.
SLICE = 1 << 18
#: A word pair of at least this share of all words is merged in all parts, by its third words. Fewer than 1 / COMMON
#: such pairs exist; which are found decides where a stripe is merged, never what it counts.
COMMON = 1e-5
UNDETERMINED = "und"

#: Bytes that end a piece, and all that part words.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = BREAK.copy()
BETWEEN[[0x20, 0x09]] = True


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """Of (lang, text), `size` bytes at a time: languages, lowered bytes, the words' ids, rows, pieces, starts and ends.

    A word's id is a hash of the word and its language, never 0.
    """
    for batch in batches:
        coded = pc.fill_null(batch.column(0).cast(pa.string()), UNDETERMINED).dictionary_encode()
        names, cuts = flat(coded.dictionary)
        salts = hashes(names, cuts[:-1], cuts[1:])[0][coded.indices.to_numpy()]
        data, offsets = flat(batch.column(1))
        for first, last in groups(offsets, size):
            low = LOWER[data[offsets[first]:offsets[last]]]
            ends_of_rows = offsets[first + 1:last + 1] - offsets[first]
            starts, ends = runs(~BETWEEN[low], ends_of_rows[:-1])
            if not len(starts):
                continue
            row = np.searchsorted(ends_of_rows, starts, side="right")
            ids = np.maximum(pair_hash(salts[first + row], hashes(low, starts, ends)[0]), np.uint64(1))
            piece = np.searchsorted(np.flatnonzero(BREAK[low]), starts) + row  # neither ever falls
            yield coded.slice(first, last - first).dictionary_decode(), low, ids, row, piece, starts, ends


def next_words(at: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the first, second and third word wherever two words follow each other in a piece; 0 for no third."""
    here = np.flatnonzero(piece[1:] == piece[:-1])
    beyond = np.minimum(here + 2, len(at) - 1)
    third = np.where((here + 2 < len(at)) & (piece[beyond] == piece[here]), at[beyond], 0)
    return at[here], at[here + 1], third


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * STEP + second)


def stripes(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Stripes merged element by element: each prefix (a, b), and of each counter the prefix's number, next word and sum.

    All words are numbers below `size`; prefixes come in order, and each one's next words too.
    """
    prefix, at = np.unique(a * size + b, return_inverse=True)
    key = at * size + c
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = bounds(key)[:-1]
    key = key[cuts]
    return prefix // size, prefix % size, key // size, key % size, np.add.reduceat(n[order], cuts)


def counted_words(size: int, share: float) -> Callable:
    """(pair, id, lang, word, n): each chunk's words, and (by hash, without words) the pairs that are common in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, low, ids, row, piece, starts, ends in chunks(batches, size):
            word, at, place, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
            first, second, _ = next_words(place, piece)
            pairs, times = np.unique(first * len(word) + second, return_counts=True)
            often = times >= max(2, share / 2 * len(ids))
            pairs, times = pairs[often], times[often]
            hashed = pair_hash(word[pairs // len(word)], word[pairs % len(word)])
            text = low.tobytes()
            spelled = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            none = pa.nulls(len(pairs), pa.string())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(word) + len(pairs)) >= len(word)), pa.array(np.concatenate([word, hashed]).view(np.int64)),
                pa.concat_arrays([langs.take(pa.array(row[at])), none]),
                pa.concat_arrays([pa.array(spelled, pa.binary()).cast(pa.string()), none]), pa.array(np.concatenate([n, times])),
            ], names=["pair", "id", "lang", "word", "n"])

    return run


def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers below 2**32, bytes of the same weight side by side, compressed."""
    planes = (np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 4, -1)
    return [np.ascontiguousarray(p.T).view("<u4").ravel() for p in planes]


def dealt_stripes(size: int, parts: int, common: np.ndarray) -> Callable:
    """(part, words, counters): each chunk's stripes, those of a part packed into one row with the words they use.

    A prefix lies in one part; the stripe of a common one lies in all parts, by its next words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, ids, _, piece, _, _ in chunks(batches, size):
            word, place = np.unique(ids, return_inverse=True)
            a, b, c = next_words(place + 1, piece)
            if not len(a):
                continue
            a, b, at, c, n = stripes(a, b, c, np.ones(len(a), np.int64), len(word) + 1)
            prefix = pair_hash(word[a - 1], word[b - 1])
            hot = np.isin(prefix, common)[at]
            with_end = np.concatenate([np.zeros(1, np.uint64), word])
            part = (np.where(hot, mix(prefix[at] + with_end[c]), prefix[at]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, a, b, c, n = part[order], a[at[order]], b[at[order]], c[order], n[order]
            cuts = bounds(part)
            used, counters = [], []
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own, back = np.unique(np.concatenate([[0], a[i:j], b[i:j], c[i:j]]), return_inverse=True)
                x, y, z = back[1:].reshape(3, -1)
                used.append(word[own[1:] - 1].tobytes())
                counters.append(packed(np.diff(x, prepend=0), y, z, n[i:j]))  # first words only grow
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(used, pa.binary()), pa.array(counters, pa.binary())],
                names=["part", "words", "counters"])

    return run


MERGED = "first long, second long, third long, n long, prefix_n long, best long, partial boolean"


def merged_stripes(least: int, common: np.ndarray) -> Callable:
    """What the merged stripes of a part say: prefixes (third is null) and extensions found `least` times at least.

    n counts the phrase, prefix_n its first two words, best the prefix's most frequent next word. Stripes of common
    prefixes are a part's share alone: partial, and put out whatever the prefix's count.
    """
    def run(table: pa.Table) -> pa.Table:
        # numbers of a part's words fit 32 bits; what is whole is held so, 64 bits are for one slice at a time
        lists = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("words")]
        words = np.unique(np.concatenate(lists))
        blobs = [x.as_buffer() for x in table.column("counters")]
        ends = np.cumsum([zstandard.frame_content_size(x) // 16 for x in blobs])
        columns = np.empty((4, ends[-1]), np.uint32)
        for blob, end, own in zip(blobs, ends.tolist(), lists, strict=True):
            number = np.concatenate([[0], np.searchsorted(words, own) + 1]).astype(np.uint32)
            x, y, z, n = unpacked(blob, 4)
            for column, value in zip(columns, (number[np.cumsum(x.view(np.int32))], number[y], number[z], n), strict=True):
                column[end - len(value):end] = value
        # a first word lies in one slice, and slices are as even as that allows
        own = ((np.cumsum(np.bincount(columns[0])) - 1) // SLICE).astype(np.uint32)[columns[0]]
        return pa.concat_tables([merged(words, *(c[own == i].astype(np.int64) for c in columns)) for i in np.unique(own).tolist()])

    def merged(words: np.ndarray, *columns: np.ndarray) -> pa.Table:
        a, b, at, c, n = stripes(*columns, len(words) + 1)
        cuts = bounds(at)[:-1]
        total = np.add.reduceat(n, cuts)
        best = np.maximum.reduceat(np.where(c > 0, n, 0), cuts)
        hot = np.isin(pair_hash(words[a - 1], words[b - 1]), common)
        prefix = np.flatnonzero((total >= least) | hot)
        longer = np.flatnonzero((n >= least) & (c > 0))
        of = at[longer]
        ids = words.view(np.int64)
        both = np.concatenate([prefix, of])
        third = pa.concat_arrays([pa.nulls(len(prefix), pa.int64()), pa.array(ids[c[longer] - 1])])
        return pa.Table.from_arrays([
            pa.array(ids[a[both] - 1]), pa.array(ids[b[both] - 1]), third, pa.array(np.concatenate([total[prefix], n[longer]])),
            pa.array(total[both]), pa.array(best[both]), pa.array(hot[both]),
        ], names=["first", "second", "third", "n", "prefix_n", "best", "partial"])

    return run


def score(a: str, left: str, right: str) -> Column:
    """1,000,000 * a * a / (l * r), rounded down; exact for counts below 10**16."""
    a, left, right = (F.col(c).cast("decimal(19,0)") for c in (a, left, right))
    above = (a * a * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", above, (left * right).cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP, lang: str = "lang",
                 text: str = "text", chunk: int = CHUNK, part: int = PART, share: float = COMMON) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two or three words.

    a counts the phrase, l and r the parts of its worst cut, n the language's words; score is a million times
    a * a / (l * r), rounded down. Phrases found in under `least` places are no candidates; one that lies in a
    longer candidate in `subsumed` of a hundred of its places goes.

    Two passes over the texts. The first counts words. The second keys, by the two words before it, a counter of
    third words (a stripe); merged element by element, a stripe gives its prefix's count, the counts of its
    extensions and the largest of them, by which the prefix may be subsumed. Chunks of some megabytes are counted
    before anything is sent; no word is a key, so a frequent one is spread by its pairs, and a pair of at least
    `share` of all words by its third words. A chunk sends a row a part, or a row a prefix if those are fewer. Words and pairs are
    told apart by 64-bit hashes.

    Rows without language are `und`, which a row may also say itself; null and empty texts have no words; repeated
    rows count as often as they are there; other columns are ignored; no words give no rows. One document is taken up
    whole. Ties of score and count go by the bytes of the phrase, so ranks are settled.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(lang).cast("string"), F.col(text).cast("string"))
    counted = texts.mapInArrow(counted_words(chunk, share), "pair boolean, id long, lang string, word string, n long")
    counted = materialize(counted.groupBy("pair", "id").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("n").alias("n")))
    words = counted.where("not pair")
    total = words.agg(F.sum("n")).first()[0] or 0
    often = counted.where(F.col("pair") & (F.col("n") >= share * total)).select("id").toPandas()["id"]
    common = np.sort(often.to_numpy(np.int64).view(np.uint64))
    parts = max(shuffle_width(spark), -(-total // part))
    dealt = texts.mapInArrow(dealt_stripes(chunk, parts, common), "part int, words binary, counters binary")
    found = materialize(dealt.repartition(parts, "part").groupBy("part").applyInArrow(merged_stripes(least, common), MERGED))

    # the few common prefixes are summed over the parts; all others are whole
    prefixes = found.where("third is null")
    shared = prefixes.where("partial").groupBy("first", "second").agg(F.sum("n").alias("n"), F.max("best").alias("best"))
    pairs = prefixes.where("not partial").select("first", "second", "n", "best").unionAll(shared.where(F.col("n") >= least))
    triples = found.where("third is not null").select("first", "second", "third", "n", "prefix_n", "partial")
    sums = shared.select(F.col("first").alias("f"), F.col("second").alias("s"), F.col("n").alias("whole"))
    triples = triples.where("not partial").drop("partial").unionAll(
        triples.where("partial").join(sums, (F.col("first") == F.col("f")) & (F.col("second") == F.col("s")))
        .select("first", "second", "third", "n", F.col("whole").alias("prefix_n")))

    rests = pairs.select(F.col("first").alias("f"), F.col("second").alias("s"), F.col("n").alias("rest_n"))
    triples = triples.join(rests, (F.col("second") == F.col("f")) & (F.col("third") == F.col("s"))).drop("f", "s")
    before = triples.groupBy(F.col("second").alias("f"), F.col("third").alias("s")).agg(F.max("n").alias("before"))
    pairs = pairs.join(before, (F.col("first") == F.col("f")) & (F.col("second") == F.col("s")), "left").drop("f", "s")
    longer = F.greatest("best", F.coalesce("before", F.lit(0)))
    pairs = pairs.where(~((longer >= least) & (100 * longer >= subsumed * F.col("n"))))
    none = F.lit(None).cast("long")
    phrases = pairs.select("first", "second", none.alias("third"), "n", none.alias("prefix_n"), none.alias("rest_n")).unionAll(
        triples.select("first", "second", "third", "n", "prefix_n", "rest_n"))

    known = words.where(F.col("n") >= least)
    for place in ("first", "second", "third"):
        phrases = phrases.join(
            known.select(F.col("id").alias("i"), F.col("word").alias(f"{place}_word"), F.col("n").alias(f"{place}_n"),
                         F.col("lang").alias(f"{place}_lang")),
            F.col(place) == F.col("i"), "left" if place == "third" else "inner").drop("i")

    one = F.struct(F.coalesce(score("n", "first_n", "rest_n"), score("n", "first_n", "second_n")).alias("score"),
                   F.lit(1).alias("k"), F.col("first_n").alias("l"), F.coalesce("rest_n", "second_n").alias("r"))
    two = F.when(F.col("third").isNotNull(), F.struct(
        score("n", "prefix_n", "third_n").alias("score"), F.lit(2).alias("k"), F.col("prefix_n").alias("l"), F.col("third_n").alias("r")))
    rated = phrases.select(
        F.col("first_lang").alias("lang"), F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"),
        F.col("n").alias("a"), F.least(one, two).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = rated.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = words.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"))
    return best.join(sizes, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))

"""Jaccard join of shingle sets: count vectors in R-trees bound the overlap, surviving pairs are verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.bytetext import flat, groups, mix, shingles, words
from gradeloom.llm.components import components
from gradeloom.llm.grouped import bounds, whole_groups
from gradeloom.llm.shipping import ship
from gradeloom.session import gathered, materialize

K = 5
PERCENT = 75
#: Buckets whose loads tell common shingles from rare ones. Their number is fixed, whatever the input.
LOADS = 1 << 22
SLICES = 16
#: Groups that a set's shingles are hashed to: the coordinates of its point.
COUNTS = 256
#: Points in a leaf of an R-tree, and children of an inner node.
FANOUT = 16
#: Times that a set of each meeting leads the others before the tree.
TURNS = 1
#: Sets that one task takes of one candidate group; larger groups are cut into such parts.
PART = 1024
#: Bits of the table by which documents are picked.
BITS = 24
#: A set takes the first so many of its meetings along, by which a pair is put out at the first that both sets have.
LISTED = 16
#: Texts unpacked at a time.
UNPACKED = 128


def rare_first(docs: DataFrame) -> np.ndarray:
    """The level of each bucket of shingles: 0 for an ordinary load, one more for each doubling beyond.

    Any order of the shingles gives right results; this one keeps shingles that very many documents have out
    of most prefixes. It counts all documents. The table holds a fixed number of small numbers (4 MB).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(LOADS, np.int32)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for a, b in groups(offsets):
                word, row, _ = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                hashed, _, _ = shingles(word, row, b - a, K)
                there, times = np.unique(bucket(hashed), return_counts=True)
                load[there] += times.astype(np.int32)
        press = zstandard.ZstdCompressor(level=1)
        parts = [press.compress(p.tobytes()) for p in load.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES)), pa.array(parts)], names=["slice", "load"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for at, load in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[at] = total.get(at, 0) + np.frombuffer(unpress.decompress(load.as_py()), np.int32).astype(np.int64)
        if total:
            press = zstandard.ZstdCompressor(level=1)
            packed = [press.compress(np.minimum(x, 2**31 - 1).astype(np.int32).tobytes()) for x in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(packed)], names=["slice", "load"])

    loads = docs.select("text").mapInArrow(run, "slice long, load binary")
    summed = loads.repartition(SLICES, "slice").mapInArrow(add, "slice long, load binary").collect()
    load = np.zeros((SLICES, LOADS // SLICES), np.int32)
    for r in summed:
        load[r.slice] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r.load)), np.int32)
    usual = max(4.0, 1.5 * float(np.median(load[0])))  # hashed, so that any slice is like the whole
    level = np.empty(load.shape, np.uint8)
    for i, part in enumerate(load):
        level[i] = np.clip(np.floor(np.log2(np.maximum(part, 1) / usual)) + 1, 0, 31)
    return level.ravel()


def bucket(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(42)).astype(np.int64)


def sets_of(batch_text: pa.Array, level: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The sorted set of each row's shingles: level in the upper bits, 58 bits of hash below."""
    data, offsets = flat(batch_text)
    for a, b in groups(offsets):
        word, row, _ = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        hashed, row, _ = shingles(word, row, b - a, K)
        key = (level[bucket(hashed)].astype(np.uint64) << np.uint64(58)) | (hashed >> np.uint64(6))
        cuts = np.searchsorted(row, np.arange(b - a + 1)).tolist()
        for i in range(b - a):
            yield a + i, np.unique(key[cuts[i]:cuts[i + 1]])


def signature(keys: np.ndarray) -> int:
    """64 bits that stand for the set. Two of n different sets share one with odds below n * n / 2**65."""
    both = mix(np.array([mix(keys).sum(dtype=np.uint64), mix(keys ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64) + np.uint64(len(keys))]))
    return int(mix(both[:1] ^ (both[1:] << np.uint64(1)))[0].view(np.int64))


def prefix(n: int) -> int:
    """Sets of similarity PERCENT or more share one of the first so many shingles of a common order."""
    return n - -(-n * PERCENT // 100) + 1


def least_overlap(n, m):
    """Shingles that sets of n and m must share."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def sizes(docs: DataFrame, level) -> DataFrame:
    """(id, signature, n, point) of every document; a point holds the counts of the groups, and is null for no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sign, n, point = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for i, keys in sets_of(batch.column(1), level.value):
                sign[i], n[i] = signature(keys), len(keys)
                point[i] = packed_point(keys) if len(keys) else None
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sign), pa.array(n), pa.array(point, pa.binary())], names=["id", "signature", "n", "point"])

    return docs.mapInArrow(run, "id long, signature long, n long, point binary")


def postings(docs: DataFrame, level) -> DataFrame:
    """(shingle, signature, n) for the prefix of every set, once per task for equal sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            parts, sign, n = [], [], []
            for _, keys in sets_of(batch.column(1), level.value):
                if len(keys) and (s := signature(keys)) not in seen:
                    seen.add(s)
                    parts.append(keys[:prefix(len(keys))])
                    sign.append(s)
                    n.append(len(keys))
            if parts:
                times = [len(p) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(np.array(sign, np.int64), times)),
                     pa.array(np.repeat(np.array(n, np.int32), times))], names=["shingle", "signature", "n"])

    return docs.mapInArrow(run, "shingle long, signature long, n int")


def wanted_bits(ids: DataFrame) -> np.ndarray:
    """A bit for each value of 24 bits that an id of the table hashes to; a fixed 2 MB, however many ids there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITS, bool)
        for batch in batches:
            bits[id_bit(batch.column(0).to_numpy())] = True
        press = zstandard.ZstdCompressor(level=1)
        parts = [press.compress(np.packbits(p).tobytes()) for p in bits.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES)), pa.array(parts)], names=["slice", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, bits in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[at] = total.get(at, 0) | np.frombuffer(zstandard.ZstdDecompressor().decompress(bits.as_py()), np.uint8)
        if total:
            press = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([press.compress(x.tobytes()) for x in total.values()])], names=["slice", "bits"])

    out = np.zeros((SLICES, (1 << BITS) // SLICES), bool)
    for r in ids.mapInArrow(run, "slice long, bits binary").repartition(SLICES, "slice").mapInArrow(join, "slice long, bits binary").collect():
        out[r.slice] = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r.bits)), np.uint8)).astype(bool)
    return out.ravel()


def id_bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def packed_texts(docs: DataFrame, ids: DataFrame, level) -> DataFrame:
    """(signature, text) of the documents of these ids, once a signature; a few others, whose bit is the same, too.

    Documents are picked where they lie, by a bit, so that only their texts travel, packed.
    """
    bits = docs.sparkSession.sparkContext.broadcast(wanted_bits(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            batch = batch.filter(pa.array(bits.value[id_bit(batch.column(0).to_numpy())]))
            sign, text = [], []
            for i, keys in sets_of(batch.column(1), level.value) if batch.num_rows else ():
                if len(keys) and (s := signature(keys)) not in seen:
                    seen.add(s)
                    sign.append(s)
                    text.append(press.compress(batch.column(1)[i].as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(sign, pa.int64()), pa.array(text, pa.binary())], names=["signature", "text"])

    # rows of one signature are the same set; one of them goes on
    return docs.mapInArrow(run, "signature long, text binary").groupBy("signature").agg(F.first("text").alias("text"))


def packed_point(keys: np.ndarray) -> bytes:
    """The counts by group, in one byte each if that is enough and in four if not."""
    count = np.bincount((keys & np.uint64(COUNTS - 1)).astype(np.int64), minlength=COUNTS)
    return count.astype(np.uint8 if count.max() < 256 else np.int32).tobytes()


def points_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row of counts for each packed point."""
    blobs = column.to_pylist()
    out = np.empty((len(blobs), COUNTS), np.int32)
    for i, blob in enumerate(blobs):
        out[i] = np.frombuffer(blob, np.uint8 if len(blob) == COUNTS else np.int32)
    return out


class RTree:
    """Points of counts in a packed R-tree: leaves of points near in size and counts, boxes above them."""

    def __init__(self, points: np.ndarray, sizes_: np.ndarray):
        widest = np.argsort(-np.var(points, axis=0), kind="stable")[:2]
        self.order = np.lexsort((points[:, widest[1]], points[:, widest[0]], np.log2(sizes_).astype(int)))
        self.points, self.sizes = points[self.order], sizes_[self.order]
        top, low = self.points, self.sizes
        self.levels = [(top, low)]
        while len(low) > FANOUT:
            cuts = np.arange(0, len(low), FANOUT)
            top, low = np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts)
            self.levels.append((top, low))

    def near(self, points: np.ndarray, sizes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.near_bounds(points, sizes_)[:2]

    def near_bounds(self, points: np.ndarray, sizes_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (number asked, number in the tree) whose overlap can reach what their sizes ask for, and how far it can reach.

        Two sets share at most the smaller count of each group, summed; below a box, at most the smaller of the
        count and the box's largest, and what is asked for is least for the box's smallest set. A few points are
        asked together and go down where any of them may.
        """
        asked, found, reach = [], [], []
        for first in range(0, len(sizes_), FANOUT):
            some, size = points[first:first + FANOUT], sizes_[first:first + FANOUT, None]
            there = np.arange(len(self.levels[-1][1]))
            for depth in range(len(self.levels) - 1, -1, -1):
                top, low = self.levels[depth]
                bound = np.minimum(top[there], some[:, None]).sum(axis=2)
                able = bound >= np.maximum(least_overlap(low[there], size), -(-PERCENT * size // 100))
                if depth:
                    there = (there[able.any(axis=0)][:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    there = there[there < len(self.levels[depth - 1][1])]
            who, what = np.nonzero(able)
            asked.append(first + who)
            found.append(self.order[there[what]])
            reach.append(bound[who, what])
        return np.concatenate(asked), np.concatenate(found), np.concatenate(reach)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def can_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b, n, point, m, other), those whose points leave room for the overlap they need."""
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (points_of(batch.column(i)) for i in (3, 5))
        need = least_overlap(batch.column(2).to_numpy().astype(np.int64), batch.column(4).to_numpy())
        kept = pa.array(np.minimum(one, two).sum(axis=1) >= need)
        yield batch.select(["a", "b"]).filter(kept)


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sets' points don't rule out."""
    both = pairs
    for side, n, point in (("a", "n", "point"), ("b", "m", "other")):
        own = sets.select(F.col("signature").alias("s"), F.col("n").alias(n), F.col("point").alias(point))
        both = both.join(own, F.col(side) == F.col("s")).drop("s")
    return both.select("a", "b", "n", "point", "m", "other").mapInArrow(can_link, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, level) -> DataFrame:
    """Those of the distinct pairs (a, b) that link, by the texts of their sets' first documents. A set that leads very many pairs is dealt over many cells."""
    def star_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each cell's first set with the others: rows (cell, rank, signature, text) by cell and rank."""
        press = zstandard.ZstdDecompressor()
        cell = lead = lead_keys = None
        for whole in batches:
            for at in range(0, whole.num_rows, UNPACKED):
                batch = whole.slice(at, UNPACKED)
                texts = pa.array([press.decompress(x) for x in batch.column(3).to_pylist()], pa.binary()).cast(pa.string())
                found = []
                rows = zip(*(batch.column(i).to_pylist() for i in range(3)), sets_of(texts, level.value), strict=True)
                for own, rank, sign, (_, keys) in rows:
                    if rank == 0:
                        cell, lead, lead_keys = own, sign, keys
                    elif own == cell and overlap(keys, lead_keys) >= least_overlap(len(keys), len(lead_keys)):
                        found.append((lead, sign))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    wide = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("cells")).withColumnRenamed("a", "lead")
    followers = pairs.join(wide, F.col("a") == F.col("lead")).select(
        F.xxhash64("a", F.pmod(F.xxhash64("b", F.lit("cell")), "cells")).alias("cell"), F.lit(1).alias("rank"), F.col("b").alias("s"))
    leaders = wide.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - F.lit(1).cast("long"))).alias("at")).select(
        F.xxhash64("lead", "at").alias("cell"), F.lit(0).alias("rank"), F.col("lead").alias("s"))
    asked = pairs.select(F.col("a").alias("s")).unionAll(pairs.select("b")).distinct()
    ids = sets.join(asked, F.col("signature") == F.col("s"), "left_semi").select("first")
    rows = leaders.unionAll(followers).join(packed_texts(docs, ids, level), F.col("s") == F.col("signature"))
    rows = rows.select("cell", "rank", "signature", "text").repartition("cell").sortWithinPartitions("cell", "rank")
    return rows.mapInArrow(star_links, "a long, b long")


def likeliest(one: np.ndarray, two: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Numbers of the pairs that are the best one of either of their components."""
    both, number = np.concatenate([one, two]), np.tile(np.arange(len(one)), 2)
    order = np.lexsort((-chance[number], both))
    return np.unique(number[order[bounds(both[order])[:-1]]])


def tree_pairs(batches: Iterator[pa.RecordBatch], few: bool = False) -> Iterator[pa.RecordBatch]:
    """Pairs that an R-tree over each cell leaves: rows (cell, side, signature, n, component, point, shingle, meetings).

    A cell holds one part of a candidate group, or two to be joined. Only sets of different components are paired. Each
    set brings its first meetings. What two such lists have in common holds the first meeting of both sets, if it is
    anything, and the pair is put out there alone; else at each meeting. With `few`, lists aren't looked at and a cell puts
    out only each component's likeliest pair, no more pairs than sets; if that leaves any, a row with its shingle, too.
    """
    for group in whole_groups(batches):
        cell, both, sign, n, component = (group.column(i).to_numpy() for i in range(5))
        points = points_of(group.column(5))
        here, meetings = group.column(6).to_numpy(), group.column(7).to_pylist()
        known = [] if few else [set(m) for m in meetings]
        n = n.astype(np.int64)
        cuts, out_a, out_b, more = bounds(cell), [], [], []
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            side = both[first:last]
            left, right = first + np.flatnonzero(side == side.min()), first + np.flatnonzero(side == side.max())
            if side.min() == side.max() and len(np.unique(component[left])) < 2:
                continue
            a, b, reach = RTree(points[right], n[right]).near_bounds(points[left], n[left])
            a, b = left[a], right[b]
            apart = (component[a] != component[b]) & ((sign[a] < sign[b]) | (side.min() != side.max()))
            a, b, reach = a[apart], b[apart], reach[apart]
            if few:
                new = likeliest(component[a], component[b], reach / (n[a] + n[b] - reach))
                if len(new) < len(a):
                    more.append(int(here[first]))
            else:
                own = int(here[first])
                new = np.array([own == min(known[i] & known[j], default=own) for i, j in zip(a.tolist(), b.tolist(), strict=True)], bool)
            a, b = a[new], b[new]
            out_a.append(np.minimum(sign[a], sign[b]))
            out_b.append(np.maximum(sign[a], sign[b]))
        if out_a:
            a, b = (pa.concat_arrays([pa.array(np.concatenate(x)), pa.nulls(len(more), pa.int64())]) for x in (out_a, out_b))
            rest = pa.concat_arrays([pa.nulls(len(a) - len(more), pa.int64()), pa.array(more, pa.int64())])
            yield pa.RecordBatch.from_arrays([a, b, rest], names=["a", "b", "more"])


def with_components(meet: DataFrame, links: DataFrame) -> DataFrame:
    """The meetings with each set's component; a set without links is its own."""
    known = components(links).withColumnRenamed("node", "k")
    return meet.join(known, F.col("signature") == F.col("k"), "left").select(
        "shingle", "signature", "n", "size", F.coalesce("component", "signature").alias("component"))


def apart_pairs(left: DataFrame, sets: DataFrame, few: bool) -> DataFrame:
    """Pairs (a, b), a the smaller, of sets that meet and are not yet connected, and meetings that hold more, see `tree_pairs`."""
    several = left.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"),
        F.count(F.lit(1)).alias("count"), F.min("size").alias("small"), F.max("size").alias("large"))
    # two sets of one size class have met as leader and follower
    several = several.where("low <> high and (count > 2 or small <> large)").select(F.col("shingle").alias("m"), "parts")
    own = F.pmod(F.xxhash64("signature", F.lit("part")), F.col("parts")).cast("int")
    met = left.join(several, F.col("shingle") == F.col("m"))
    points = sets.select(F.col("signature").alias("s"), "point")
    if few:
        points = points.withColumn("meetings", F.lit(None).cast("array<long>"))
    else:  # no longer than a set's prefix
        lists = met.groupBy(F.col("signature").alias("k")).agg(F.slice(F.array_sort(F.collect_list("shingle")), 1, LISTED).alias("meetings"))
        points = points.join(lists, F.col("s") == F.col("k"), "left").select("s", "point", "meetings")
    cells = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select(F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "own",
                         "signature", "n", "component", "shingle")
    cells = cells.join(points, F.col("s") == F.col("signature")).select("cell", "own", "s", "n", "component", "point", "shingle", "meetings")
    rows = cells.repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(lambda batches: tree_pairs(batches, few), "a long, b long, more long").distinct()


def near_groups(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id): documents linked by shingle sets of similarity 0.75 or more.

    Words lie between white space, A-Z lower-cased; a set holds the runs of five words, or all words as one
    run if there are fewer. Texts without words, null or empty, link with nothing. Repeated rows are answered one by
    one; texts that share a doc_id are connected, each row with its own n_shingles. A null doc_id takes no part and
    keeps a null component. Other columns are ignored. No rows give no rows. component_id is the smallest doc_id reachable.

    Equal sets are one set with one signature. Sets meet if the rarest quarter of their shingles has one in
    common, which similar sets always have. Sets that meet at a shingle are first linked with a few of their
    kind in size, by turns, which ties up groups of copies without spelling out their pairs; then an R-tree over
    the counts of each meeting's sets finds the pairs of sets not yet connected that can still be similar: first the
    likeliest of each component alone, then all that are still apart. Each time the shingles themselves decide.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col(key).cast("long").alias("id"), F.col("text"))
    named = slim.where("id is not null")
    level = docs.sparkSession.sparkContext.broadcast(rare_first(named))
    signed = materialize(sizes(slim, level))
    meet = postings(named, level)
    at = Window.partitionBy("shingle").orderBy("size", "signature")
    # sizes of one class are similar enough for a link
    meet = meet.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT))).cast("int"))
    meet = meet.select("shingle", "signature", "n", "size", F.lag("signature").over(at).alias("before"), F.lead("signature").over(at).alias("after"))
    meet = meet.where("(before is not null and before <> signature) or (after is not null and after <> signature)")
    # written once, as the postings of all documents are its input and two plans go on from it
    meet = gathered(meet.select("shingle", "signature", "n", "size").distinct())
    # shingles at which the same sets meet are as good as one
    who = meet.groupBy("shingle").agg(
        F.bit_xor(F.xxhash64("signature")).alias("x"), F.bit_xor(F.xxhash64("signature", F.lit("y"))).alias("y"), F.count(F.lit(1)).alias("c"))
    one = who.groupBy("x", "y", "c").agg(F.min("shingle").alias("m"))
    meet = gathered(meet.join(one, F.col("shingle") == F.col("m"), "left_semi"))
    # one set for every signature that meets another, with its smallest document; a doc_id may have several texts
    first = signed.where("id is not null and n > 0").groupBy("signature").agg(F.min("id").alias("first"))
    points_ = signed.where("id is not null and n > 0").groupBy("signature").agg(
        F.min("id").alias("first"), F.first("n").cast("int").alias("n"), F.first("point").alias("point"))
    sets = gathered(points_.join(meet.select("signature").distinct(), "signature", "left_semi"))

    links = tried = None
    left = meet.withColumn("component", F.col("signature"))
    for turn in range(TURNS):  # another set leads each time, and only sets apart from it are tried
        order = F.struct(F.xxhash64("signature", F.lit(turn)), F.col("signature"))
        leads = left.groupBy("shingle", "size").agg(F.min_by(F.struct("signature", "component"), order).alias("lead"))
        stars = left.join(leads, ["shingle", "size"]).where("component <> lead.component").select(
            F.col("lead.signature").alias("a"), F.col("signature").alias("b")).distinct()
        stars = gathered(bounded(stars, sets))
        tried = stars if tried is None else tried.unionAll(stars)
        found = gathered(verified(stars, sets, named, level))
        links = found if links is None else links.unionAll(found)
        left = with_components(meet, links)
    # first each component's likeliest pairs, which tie up most of a group of near copies; then all that are left apart
    for few in (True, False):
        found = gathered(apart_pairs(left, sets, few))
        pairs = gathered(found.where("a is not null").select("a", "b").join(
            tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        links = links.unionAll(gathered(verified(pairs, sets, named, level)))
        if few:  # a meeting whose pairs were all put out has no others
            more = found.where("more is not null").select(F.col("more").alias("m"))
            meet = meet.join(more, F.col("shingle") == F.col("m"), "left_semi")
            tried, left = tried.unionAll(pairs), with_components(meet, links)

    # texts of one doc_id are one node
    own = signed.where("id is not null and n > 0").groupBy("id").agg(F.min("signature").alias("a"), F.max("signature").alias("z"))
    own = own.where("a <> z").withColumnRenamed("id", "i")
    links = links.unionAll(signed.where("n > 0").join(own, F.col("id") == F.col("i")).where("signature <> a").select("a", F.col("signature").alias("b")))
    linked = components(links).withColumnRenamed("node", "k")
    firsts = first.join(linked, F.col("signature") == F.col("k"), "left").withColumn("component", F.coalesce("component", "signature"))
    smallest = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    named_sets = firsts.select(F.col("signature").alias("k"), "component").join(smallest, "component").select("k", "component_id")
    out = signed.join(named_sets, (F.col("signature") == F.col("k")) & (F.col("n") > 0) & F.col("id").isNotNull(), "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stand for their group of near copies: those whose doc_id is the smallest in it.

    Documents without doc_id or without words stay; so does every row of a doc_id that stays, repeated ones too. All
    columns are kept. No rows give no rows.
    """
    kept = near_groups(docs).where("doc_id = component_id or doc_id is null").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")

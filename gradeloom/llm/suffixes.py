"""Bytes that an earlier document has too, by a distributed merge sort of suffixes.

Texts are cut into windows of SPAN bytes. A window is found again wherever its text stands, at the suffix that
begins at the window's anchor: the place in it whose next GRAM bytes have the smallest hash. Only these suffixes
are sorted, about one for eighteen bytes. Suffixes whose first GRAM bytes stand in one document alone are known
by an exchange of hashes and stay behind; those left are sorted within their chunk, front-coded, exchanged and
merged by a loser tree that goes by common prefixes. A chunk sends each different suffix once and gets the smallest
id of each of its windows back; which places they stand at it finds again by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.bytetext import BYTE, flat, mix, powers, runs
from gradeloom.llm.grouped import bounds
from gradeloom.llm.shipping import ship
from gradeloom.session import materialize

SPAN = 50
GRAM = 16
#: Places a window's anchor can have, and so the most bytes of a window before it.
PLACES = SPAN - GRAM + 1
BEFORE = PLACES - 1
#: An entry: the suffix from the anchor on, the bytes before it backwards, and how many of either are there.
WIDTH = SPAN + BEFORE + 2
#: Text in a chunk, whose suffixes are one sorted run, and text behind one part of the merge, both about.
CHUNK_BYTES = 8 << 20
PART_BYTES = 8 << 20
#: Window starts looked at at a time; their numbers take the lower bits of a hash.
BLOCK = 1 << 20
NUMBER = np.uint64((1 << 22) - 1)
#: Suffixes written out or answered for at a time.
PLACES_AT_ONCE = 1 << 16
NEVER = np.iinfo(np.int64).max


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of bytes or numbers as one compressed string."""
    parts = [np.ascontiguousarray(a).view(np.uint8).ravel().tobytes() for a in arrays]
    head = np.array([len(p) for p in parts], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def unsqueeze(blob: bytes, *kinds: type) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(plain, np.int64, len(kinds)).tolist(), kinds, strict=True):
        out.append(np.frombuffer(plain[at:at + size], kind))
        at += size
    return out


def chunks(docs: DataFrame) -> DataFrame:
    """Documents a chunk a row: (chunk, bytes, body); a body holds ids, which are null, offsets and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def body() -> pa.RecordBatch:
            text = np.concatenate([t for _, _, _, t in held])
            lengths = np.concatenate([x for _, _, x, _ in held])
            packed = squeeze(np.concatenate([i for i, _, _, _ in held]), np.concatenate([n for _, n, _, _ in held]), lengths, text)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(text)]), pa.array([packed])], names=["chunk", "bytes", "body"])

        for batch in batches:
            data, offsets = flat(batch.column(1))
            ids = batch.column(0).fill_null(0).to_numpy()
            none = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES - size, side="right")) - 1)
                last = min(last, len(ids))
                held.append((ids[first:last], none[first:last], np.diff(offsets[first:last + 1]), data[offsets[first]:offsets[last]].copy()))
                size += int(offsets[last] - offsets[first])
                first = last
                if size >= CHUNK_BYTES or first < len(ids):
                    yield body()
                    number, held, size = number + 1, [], 0
        if held:
            yield body()

    return docs.mapInArrow(run, "chunk long, bytes long, body binary")


class Chunk:
    def __init__(self, body: bytes):
        self.ids, self.none, lengths, self.text = unsqueeze(body, np.int64, np.bool_, np.int64, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors of all windows: place, bytes before it and behind it that its windows take, and hash."""
        text, ends = self.text, self.offsets[1:]
        if len(text) < SPAN:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        # no window begins in a document's last bytes, nor in a document without id
        change = np.zeros(len(text) + 1, np.int32)
        np.add.at(change, np.where(self.none, self.offsets[:-1], np.maximum(self.offsets[:-1], ends - SPAN + 1)), 1)
        np.add.at(change, ends, -1)
        fine = np.cumsum(change[:-1]) == 0
        fine[len(text) - SPAN + 1:] = False
        out = []
        for start in range(0, len(text) - SPAN + 1, BLOCK):
            part = text[start:start + BLOCK + SPAN - 1]
            up, down = powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(BYTE[part] * up[:len(part)], out=sums[1:])
            gram = mix((sums[GRAM:] - sums[:-GRAM]) * down[:len(part) - GRAM + 1])
            least = (gram & ~NUMBER) | np.arange(len(gram), dtype=np.uint64)
            wide = 1
            while wide < PLACES:  # the least of twice as many places, at last of all
                step = min(wide, PLACES - wide)
                least = np.minimum(least[:-step], least[step:])
                wide += step
            starts = np.flatnonzero(fine[start:start + len(least)])
            if not len(starts):
                continue
            anchor = (least[starts] & NUMBER).astype(np.int64)
            new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)]))
            last = np.append(new[1:], len(starts)) - 1
            at = anchor[new]
            out.append((at + start, (at - starts[new]).astype(np.uint8), (starts[last] + SPAN - at).astype(np.uint8), gram[at]))
        if not out:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def shared(self, replies: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of suffixes whose first bytes two documents have: place, distinct entries by part and order, their parts,
        and each suffix's entry."""
        at, before, behind, gram = self.suffixes()
        key, inverse = keyed(gram, parts)
        part = (key >> np.uint64(40)).astype(np.int64)
        cuts = bounds(part)
        bits = {r["part"]: r["bits"] for r in replies}
        several = np.zeros(len(key), bool)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            several[a:b] = np.unpackbits(np.frombuffer(bits[int(part[a])], np.uint8), count=b - a)
        kept = np.flatnonzero(several[inverse])
        part = part[inverse[kept]]
        # equal suffixes are one before the next are looked at, so that entries are never written out for all places
        kind, found, to, count = f"S{4 + WIDTH}", [], [], 0
        for a in range(0, len(kept), PLACES_AT_ONCE):
            own = kept[a:a + PLACES_AT_ONCE]
            rows = np.empty((len(own), 4 + WIDTH), np.uint8)
            rows[:, :4] = part[a:a + len(own)].astype(">u4").view(np.uint8).reshape(-1, 4)
            rows[:, 4:] = entries(self.text, at[own], before[own], behind[own])
            distinct, entry = np.unique(rows.view(kind).ravel(), return_inverse=True)
            found.append(distinct)
            to.append(entry + count)
            count += len(distinct)
        distinct, entry = np.unique(np.concatenate([np.zeros(0, kind), *found]), return_inverse=True)
        rows = distinct.view(np.uint8).reshape(-1, 4 + WIDTH)
        row_part = np.ascontiguousarray(rows[:, :4]).view(">u4").ravel().astype(np.int64)
        return at[kept], rows[:, 4:], row_part, entry[np.concatenate([np.zeros(0, np.int64), *to])]

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets[1:], at, side="right")


def keyed(gram: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, by part of the merge (upper bits) and hash (lower 40 bits), and each suffix's key."""
    spread = mix(gram)
    return np.unique(((spread % np.uint64(parts)) << np.uint64(40)) | (spread >> np.uint64(24)), return_inverse=True)


def first_bytes(held: DataFrame, parts: int) -> DataFrame:
    """Per chunk and part, sorted hashes of the suffixes' first bytes: (part, chunk, hashes, several)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk = Chunk(body.as_py())
                at, _, _, gram = chunk.suffixes()
                key, inverse = keyed(gram, parts)
                owner = chunk.ids[chunk.owner(at)]
                low, high = np.full(len(key), NEVER), np.full(len(key), -NEVER)
                np.minimum.at(low, inverse, owner)
                np.maximum.at(high, inverse, owner)
                part = (key >> np.uint64(40)).astype(np.int64)
                cuts = bounds(part)
                raw = (key & np.uint64((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
                pairs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[cuts[:-1]]), pa.array(np.full(len(pairs), number)),
                    pa.array([raw[a:b].tobytes() for a, b in pairs], pa.binary()),
                    pa.array([np.packbits(low[a:b] != high[a:b]).tobytes() for a, b in pairs], pa.binary()),
                ], names=["part", "chunk", "hashes", "several"])

    return held.select("chunk", "body").mapInArrow(run, "part long, chunk long, hashes binary, several binary")


def shared_bytes(group: pa.Table) -> pa.Table:
    """Of one part: for each chunk, a bit for each hash that two documents have."""
    raw = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, 5) for x in group.column("hashes")]
    hashes = np.zeros((sum(map(len, raw)), 8), np.uint8)
    hashes[:, :5] = np.concatenate(raw)
    several = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(r)) for x, r in zip(group.column("several"), raw, strict=True)])
    _, inverse, times = np.unique(hashes.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
    times += np.bincount(inverse, weights=several, minlength=len(times)).astype(np.int64)
    bits = times[inverse] > 1
    ends = np.cumsum([len(r) for r in raw])
    out = [np.packbits(bits[e - len(r):e]).tobytes() for e, r in zip(ends.tolist(), raw, strict=True)]
    return pa.table({"part": group.column("part"), "chunk": group.column("chunk"), "bits": pa.array(out, pa.binary())})


def common(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before it."""
    differ = rows[1:] != rows[:-1]
    return np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])]) if len(rows) else np.zeros(0, np.int64)


def entries(text: np.ndarray, at: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(at), WIDTH), np.uint8)
    for j in range(SPAN):
        there = behind > j
        rows[there, j] = text[at[there] + j]
    for j in range(BEFORE):
        there = before > j
        rows[there, SPAN + j] = text[at[there] - 1 - j]
    rows[:, -2], rows[:, -1] = behind, before
    return rows


def sorted_runs(held: DataFrame, parts: int) -> DataFrame:
    """Per chunk and part, its distinct suffixes, sorted and front-coded, and the smallest id of each: (part, chunk, run, first).

    `held` has chunk, body and replies, an array of (part, bits). Where the suffixes stand stays in the chunk.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body, replies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                chunk = Chunk(body.as_py())
                at, rows, part, entry = chunk.shared(replies.as_py(), parts)
                if not len(at):
                    continue
                first = np.full(len(rows), NEVER)
                np.minimum.at(first, entry, chunk.ids[chunk.owner(at)])
                out = []
                cuts = bounds(part)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    same = common(rows[a:b])
                    rest = rows[a:b][np.arange(WIDTH) >= same[:, None]]
                    out.append((int(part[a]), squeeze(same.astype(np.uint8), rest), squeeze(first[a:b])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([p for p, _, _ in out]), pa.array([number] * len(out), pa.int64()),
                    pa.array([r for _, r, _ in out], pa.binary()), pa.array([f for _, _, f in out], pa.binary()),
                ], names=["part", "chunk", "run", "first"])

    return held.select("chunk", "body", "replies").mapInArrow(run, "part long, chunk long, run binary, first binary")


def front_decoded(same: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The entries of a front-coded run: a byte not written is that of the last row that has it written."""
    rows = np.zeros((len(same), WIDTH), np.uint8)
    written = np.arange(WIDTH) >= same[:, None]
    rows[written] = rest
    for j in range(WIDTH):
        source = np.maximum.accumulate(np.where(written[:, j], np.arange(len(same)), 0))
        rows[:, j] = rows[source, j]
    return rows


def merge(run_rows: list[list[bytes]], run_same: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs by a loser tree: the run each entry comes from, and its bytes in common with the one before.

    Contenders are known by the prefix they share with the last winner: the longer wins, and only equal ones are
    compared, from there on. A run's next entry brings that prefix along from its front coding.
    """
    count = len(run_rows)
    leaves = 1
    while leaves < count:
        leaves *= 2
    at = [0] * leaves
    share = [0 if i < count and run_rows[i] else -1 for i in range(leaves)]  # -1: the run is at its end

    def beats(x: int, y: int) -> bool:
        """Whether run x's entry comes first; the loser's prefix is then that shared with the winner."""
        if share[x] != share[y]:
            return share[x] > share[y]
        if share[x] < 0:
            return True
        known = share[x]
        a, b = run_rows[x][at[x]][known:], run_rows[y][at[y]][known:]
        if a == b:
            share[y] = known + len(b)
            return True
        more = len(a) - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8
        if a < b:
            share[y] = known + more
            return True
        share[x] = known + more
        return False

    loser = [0] * leaves
    front = list(range(leaves))
    while len(front) > 1:
        level = []
        for i in range(0, len(front), 2):
            x, y = front[i], front[i + 1]
            win, lose = (x, y) if beats(x, y) else (y, x)
            loser[(len(front) + i) // 2] = lose
            level.append(win)
        front = level
    best, source, prefix = front[0], [], []
    while share[best] >= 0:
        source.append(best)
        prefix.append(share[best])
        at[best] += 1
        share[best] = run_same[best][at[best]] if at[best] < len(run_rows[best]) else -1
        node, x = (leaves + best) // 2, best
        while node:
            y = loser[node]
            if share[y] > share[x] or (share[y] == share[x] and not beats(x, y)):
                loser[node], x = x, y
            node //= 2
        best = x
    return source, prefix


def repeated(group: pa.Table) -> pa.Table:
    """Of one part: for each chunk and entry it sent, the smallest id that has the window, by bytes before the anchor."""
    runs_ = []
    for blob in group.column("run"):
        same, rest = unsqueeze(blob.as_py(), np.uint8, np.uint8)
        runs_.append((front_decoded(same.astype(np.int64), rest), same))
    source, prefix = merge([[bytes(r) for r in rows] for rows, _ in runs_], [same.tolist() for _, same in runs_])
    source, prefix = np.array(source, np.int64), np.array(prefix, np.int64)
    # entries in merged order: the i-th of run r is the i-th place that came from r
    position = np.argsort(source, kind="stable")
    rows = np.empty((len(source), WIDTH), np.uint8)
    rows[position] = np.concatenate([r for r, _ in runs_])
    first = np.empty(len(source), np.int64)
    first[position] = np.concatenate([unsqueeze(x.as_py(), np.int64)[0] for x in group.column("first")])
    behind, before = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    back = np.argsort(np.ascontiguousarray(rows[:, SPAN:SPAN + BEFORE]).view(f"S{BEFORE}").ravel(), kind="stable")
    back_same = common(rows[back, SPAN:SPAN + BEFORE])
    earliest = np.full((len(rows), PLACES), NEVER)
    for j in range(PLACES):  # windows with j bytes before the anchor
        has = np.flatnonzero((before >= j) & (behind >= SPAN - j))
        if not len(has):
            continue
        ahead = np.cumsum(prefix < SPAN - j)
        behind_rank = np.empty(len(rows), np.int64)
        behind_rank[back] = np.cumsum(back_same < j)
        window = ahead[has] * (len(rows) + 1) + behind_rank[has]
        order = np.argsort(window, kind="stable")
        cuts = bounds(window[order])
        low = np.minimum.reduceat(first[has][order], cuts[:-1])
        earliest[has[order], j] = np.repeat(low, np.diff(cuts))
    out, start = [], 0
    for _, same in runs_:
        out.append(steps(earliest[position[start:start + len(same)]]))
        start += len(same)
    return pa.table({"part": group.column("part"), "chunk": group.column("chunk"), "earliest": pa.array(out, pa.binary())})


def steps(earliest: np.ndarray) -> bytes:
    """Rows of PLACES numbers, each number written where it differs from the one before."""
    new = np.ones(earliest.shape, bool)
    new[:, 1:] = earliest[:, 1:] != earliest[:, :-1]
    return squeeze(np.packbits(new, axis=1), earliest[new])


def unsteps(blob: bytes) -> np.ndarray:
    new, value = unsqueeze(blob, np.uint8, np.int64)
    new = np.unpackbits(new.reshape(-1, -(-PLACES // 8)), axis=1, count=PLACES)
    return value[np.cumsum(new.ravel(), dtype=np.int64) - 1].reshape(new.shape)


def mark(chunk: Chunk, replies: list[dict], answers: list[dict], parts: int, change: np.ndarray) -> None:
    """Add to `change` 1 where bytes begin that an earlier document has too, and take 1 where they end."""
    at, _, part, entry = chunk.shared(replies, parts)
    order = np.argsort(entry, kind="stable")
    cuts = bounds(part)
    ends = np.searchsorted(entry[order], cuts)
    given = {r["part"]: r["earliest"] for r in answers}
    for a, first, last in zip(cuts[:-1].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        earliest = unsteps(given[int(part[a])])
        for start in range(first, last, PLACES_AT_ONCE):
            own = order[start:min(start + PLACES_AT_ONCE, last)]
            twice = np.zeros((len(own), PLACES + 2), np.int8)
            twice[:, 1:-1] = earliest[entry[own] - a] < chunk.ids[chunk.owner(at[own])][:, None]
            step = np.diff(twice, axis=1)
            who, low = np.nonzero(step == 1)
            _, high = np.nonzero(step == -1)
            np.add.at(change, at[own][who] - high + 1, 1)
            np.add.at(change, at[own][who] - low + SPAN, -1)


def cut_out(held: DataFrame, parts: int) -> DataFrame:
    """One row for each document of the chunks (chunk, body, replies, answers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, replies, answers in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                chunk = Chunk(body.as_py())
                change = np.zeros(len(chunk.text) + 1, np.int32)
                if answers.is_valid:
                    mark(chunk, replies.as_py(), answers.as_py(), parts, change)
                gone = np.cumsum(change[:-1]) > 0
                count = len(chunk.ids)
                removed = np.concatenate([[0], np.cumsum(gone)])[chunk.offsets]
                spans = np.bincount(chunk.owner(runs(gone, chunk.offsets[1:-1])[0]), minlength=count)[:count] if len(gone) else np.zeros(count, np.int64)
                left = chunk.text[~gone].tobytes()
                kept = chunk.offsets - removed
                texts = [left[a:b] for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk.ids, mask=chunk.none), pa.array(np.diff(chunk.offsets)), pa.array(np.diff(removed)), pa.array(spans),
                    pa.array(texts, pa.binary()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return held.select("chunk", "body", "replies", "answers").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256): every document less what earlier ones have.

    A byte goes if it lies in a string of SPAN bytes that also starts in a document with a smaller doc_id;
    strings are judged on the input. Texts are UTF-8 bytes, `kept` is binary as a cut may divide a character.
    Null texts are empty. A row without doc_id loses nothing and takes nothing from others; rows that share a
    doc_id don't take from each other. Other columns are ignored. No rows give no rows.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    held = materialize(chunks(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("body"))))
    size = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(width, -(-size.b // PART_BYTES))
    # the filter, true for all, makes both joins read one and the same exchange of the bodies
    bodies = held.select("chunk", "body").where("chunk is not null").repartition(max(1, size.n), "chunk")
    bits = first_bytes(held, parts).groupBy("part").applyInArrow(shared_bytes, "part long, chunk long, bits binary")
    replies = materialize(bits.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("replies")))
    runs_ = sorted_runs(bodies.join(replies, "chunk"), parts)
    answers = runs_.groupBy("part").applyInArrow(repeated, "part long, chunk long, earliest binary")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("part", "earliest")).alias("answers"))
    return cut_out(bodies.join(replies, "chunk", "left").join(answers, "chunk", "left"), parts)

"""Language-model scores: word counts of all training text, and a causal self-attention model on subword ids."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.bytetext import flat, groups, words
from gradeloom.llm.shipping import ship
from gradeloom.llm.subwords import subwords
from gradeloom.session import materialize

#: Ids of the tokenizer; the ids' own input vectors, others share one for each class; classes of the output,
#: most for single frequent ids, one for the end, CROWDS for the rest by frequency; width of the model. A class is
#: told by its group of MEMBERS neighbours and its place there, so that 16 numbers are worked out and not 64.
VOCABULARY, OWN, CLASSES, CROWDS, WIDTH = 49_408, 2_048, 64, 16, 16
GROUPS = MEMBERS = 8
END = CLASSES - CROWDS - 1
#: A window sees CONTEXT ids and scores the last STRIDE of them; windows begin STRIDE apart.
CONTEXT, STRIDE = 32, 16
#: The attention weights begin with at most so many documents, those with the smallest hash of doc_id, and at
#: most so many windows of them, so that all tasks start alike. Then they learn from all training documents.
SAMPLE, WINDOWS = 1_000, 60_000
BATCH, RATE = 64, 0.01
#: Learning rates of the rounds over all training documents, each of which is in one round. In a round the documents
#: are dealt by hash to shards of about SHARD inputs, whatever the partitions. Each shard learns apart, by batches of
#: LOCAL_BATCH windows; then the weights are averaged, FAN at a time. Shards are dealt to at most TASKS tasks.
ROUNDS = (0.004, 0.002)
SHARD, LOCAL_BATCH, FAN, TASKS = 1 << 21, 128, 64, 20_000
#: Windows worked out at a time, learning and scoring; what they need stays in a core's cache.
LEARNED, SCORED = 128, 256
#: Frequent words whose counts every task holds (16 bytes each); the counts of all others are joined.
FREQUENT = 1 << 19


@dataclass
class Vocabulary:
    """What follows from the ids' counts: input row and output class of each id, its log share of the class."""

    into: np.ndarray
    class_: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        rank = np.empty(VOCABULARY, np.int64)
        order = np.argsort(-counts, kind="stable")
        rank[order] = np.arange(VOCABULARY)
        smooth = counts + 0.5
        mass = np.cumsum(smooth[order])
        rest = mass - mass[END - 1]
        crowd = np.minimum((rest / rest[-1] * CROWDS).astype(np.int64), CROWDS - 1)
        by_rank = np.where(np.arange(VOCABULARY) < END, np.arange(VOCABULARY), END + 1 + crowd)
        class_ = by_rank[rank]
        total = np.bincount(class_, weights=smooth, minlength=CLASSES)
        into = np.where(rank < OWN, rank, OWN + class_)
        return cls(into.astype(np.int16), class_.astype(np.int16), np.log(smooth / total[class_]).astype(np.float32))


#: The input row that stands before a document's first id.
START = OWN + CLASSES
ROWS = START + 1


def windows(counts: np.ndarray, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of so many inputs, one after the other: inputs by window, which are there, which are scored.

    Input i of a document stands before what is scored at i. Each window scores up to STRIDE inputs that no
    other one scores, and also sees the ones before. With `chosen`, of these windows alone, in their order.
    """
    number = -(-counts // STRIDE)
    firsts = np.cumsum(counts) - counts
    document = np.repeat(np.arange(len(counts)), number)
    step = np.arange(len(document)) - np.repeat(np.cumsum(number) - number, number)
    if chosen is not None:
        document, step = document[chosen], step[chosen]
    local = (step * STRIDE - (CONTEXT - STRIDE))[:, None] + np.arange(CONTEXT)
    there = (local >= 0) & (local < counts[document][:, None])
    at = np.where(there, firsts[document][:, None] + local, 0)
    scored = there.copy()
    scored[:, :CONTEXT - STRIDE] = False
    return at, there, scored


def sequences(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (a start and then the ids), targets (the ids and then the end), log shares of the targets' classes."""
    firsts = np.cumsum(counts) - counts
    into = np.insert(vocabulary.into[ids], firsts, START)
    class_ = np.insert(vocabulary.class_[ids], firsts + counts, END)
    share = np.insert(vocabulary.share[ids], firsts + counts, np.float32(0))
    return into.astype(np.int64), class_.astype(np.int64), share


DISTANCE = np.arange(CONTEXT)[:, None] - np.arange(CONTEXT)
CAUSAL = (DISTANCE >= 0).astype(np.float32)
#: Places of an input row's numbers.
CELLS = np.arange(ROWS * WIDTH).reshape(ROWS, WIDTH)


def start_weights(seed: int = 11) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    draw = lambda *shape: (random.standard_normal(shape) * 0.2).astype(np.float32)
    return {"e": draw(ROWS, WIDTH), "q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH), "v": draw(WIDTH, WIDTH),
            "r": draw(WIDTH, WIDTH), "far": np.zeros(CONTEXT, np.float32), "b": np.zeros(WIDTH, np.float32),
            "u": draw(WIDTH, GROUPS), "c": np.zeros(GROUPS, np.float32),
            "m": draw(GROUPS, WIDTH, MEMBERS), "d": np.zeros((GROUPS, MEMBERS), np.float32)}


def attend(score: np.ndarray, far: np.ndarray, causal: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Attention weights before division by their sums, from scaled products and in their place, never to later inputs."""
    score += far[np.maximum(distance, 0)]
    np.clip(score, -30, 30, out=score)
    np.exp(score, out=score)
    score *= causal
    return score


def grouped(y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that puts equal groups of classes together, and (group, first, end) of those that are there."""
    group = (y // MEMBERS).astype(np.int16)
    ends = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
    return np.argsort(group, kind="stable"), [(g, a, b) for g, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def logits(w: dict[str, np.ndarray], h: np.ndarray, parts: list[tuple[int, int, int]]) -> np.ndarray:
    """Of rows ordered by their targets' groups: first the groups' logits, then those of the members of the target's."""
    z = np.empty((2, len(h), MEMBERS), h.dtype)
    np.matmul(h, w["u"], out=z[0])
    z[0] += w["c"]
    for g, a, b in parts:
        np.matmul(h[a:b], w["m"][g], out=z[1, a:b])
        z[1, a:b] += w["d"][g]
    return np.clip(z, -30, 30, out=z)


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, there: np.ndarray, n: int = 0,
              with_loss: bool = True) -> tuple[float | None, dict[str, np.ndarray]]:
    """Loss over a batch of windows and its gradient, divided by n, or else by the inputs that are there; all of these are scored.

    Inputs of all windows are rows of flat matrices but for the products inside a window. Columns of `f` and `to_f`
    are q, k, v and r side by side. Attention is divided by its sums where rows are narrow.
    """
    size, kind, n = x.shape[0], w["e"].dtype, n or max(int(there.sum()), 1)
    root = kind.type(np.sqrt(WIDTH))
    one = lambda n: np.ones(n, kind)
    side = [slice(i * WIDTH, (i + 1) * WIDTH) for i in range(4)]
    to = np.concatenate([w["q"] / root, w["k"], w["v"], w["r"]], axis=1)
    e = w["e"].take(x.ravel(), axis=0)
    f = e @ to
    q, k, v = (f.reshape(size, CONTEXT, -1)[:, :, part] for part in side[:3])
    a = attend(q @ k.transpose(0, 2, 1), w["far"], CAUSAL, DISTANCE)
    some = np.flatnonzero(~there.all(axis=1))
    a[some] *= there[some][:, None, :]
    total = np.maximum(a.reshape(-1, CONTEXT) @ one(CONTEXT), kind.type(1e-30))[:, None]
    seen = (a @ v).reshape(-1, WIDTH)
    seen /= total
    h = seen + f[:, side[3]]
    h += w["b"]
    np.tanh(h, out=h)

    order, parts = grouped(y.ravel())
    # places of the targets' groups and members among all probabilities
    group, member = np.divmod(y.ravel()[order], MEMBERS)
    own = np.concatenate([group, member + len(h) * MEMBERS])
    own.reshape(2, -1)[:] += np.arange(0, len(h) * MEMBERS, MEMBERS)
    late = h.take(order, axis=0)
    p = logits(w, late, parts)
    np.exp(p, out=p)
    p /= (p.reshape(-1, MEMBERS) @ one(MEMBERS)).reshape(2, -1, 1)
    right = p.ravel().take(own)
    scored, loss = there.ravel()[order], None
    if with_loss:
        loss = float(-np.log(np.maximum(right[:len(h)] * right[len(h):], 1e-30))[scored].sum() / n)
    p.ravel()[own] = right - 1
    p *= (scored / kind.type(n)).astype(kind)[:, None]
    g = {"u": late.T @ p[0], "c": one(len(h)) @ p[0], "m": np.zeros_like(w["m"]), "d": np.zeros_like(w["d"])}
    to_late = p[0] @ w["u"].T
    for group, first, end in parts:
        own = p[1, first:end]
        g["m"][group], g["d"][group] = late[first:end].T @ own, one(end - first) @ own
        to_late[first:end] += own @ w["m"][group].T
    late *= late
    to_late *= 1 - late
    to_h = np.empty_like(to_late)
    to_h[order] = to_late

    to_f = np.empty_like(f)
    to_f[:, side[3]] = to_h
    g["b"] = one(len(h)) @ to_h
    to_h /= total
    windows_ = to_h.reshape(size, CONTEXT, WIDTH)
    to_a = windows_ @ v.transpose(0, 2, 1)
    to_a -= np.einsum("ij,ij->i", to_h, seen).reshape(size, CONTEXT, 1)
    to_a *= a
    by_place = (one(size) @ to_a.reshape(size, -1)).reshape(CONTEXT, CONTEXT) * CAUSAL
    g["far"] = np.bincount(np.maximum(DISTANCE, 0).ravel(), weights=by_place.ravel(), minlength=CONTEXT).astype(kind)
    apart = to_f.reshape(size, CONTEXT, -1)
    np.matmul(to_a, k, out=apart[:, :, side[0]])
    np.matmul(to_a.transpose(0, 2, 1), q, out=apart[:, :, side[1]])
    np.matmul(a.transpose(0, 2, 1), windows_, out=apart[:, :, side[2]])
    both = e.T @ to_f
    g |= {name: both[:, part] for name, part in zip("qkvr", side, strict=True)}
    g["q"] = g["q"] / root
    cell = CELLS.take(x.ravel(), axis=0)
    g["e"] = np.bincount(cell.ravel(), weights=(to_f @ to.T).ravel(), minlength=w["e"].size).reshape(w["e"].shape).astype(kind)
    return loss, g


def batch_gradient(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, there: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the mean loss over a batch, LEARNED windows at a time."""
    n, total = max(int(there.sum()), 1), None
    for first in range(0, len(x), LEARNED):
        part = slice(first, first + LEARNED)
        _, g = gradients(w, x[part], y[part], there[part], n, with_loss=False)
        if total is None:
            total = g
        else:
            for name, d in g.items():
                total[name] += d
    return total


class Adam:
    """Changes weights in place by their gradients; from here on, the weights are parts of one flat array."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.names, self.steps = list(w), 0
        self.flat = np.concatenate([v.ravel() for v in w.values()])
        cuts = np.cumsum([v.size for v in w.values()])[:-1]
        w.update({k: part.reshape(w[k].shape) for k, part in zip(self.names, np.split(self.flat, cuts), strict=True)})
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        mean, square, d = self.mean, self.square, np.concatenate([g[name].ravel() for name in self.names])
        mean *= 0.9
        mean += 0.1 * d
        square *= 0.99
        d *= d
        d *= 0.01
        square += d
        by = np.sqrt(square, out=d)
        by /= math.sqrt(1 - 0.99 ** self.steps)
        by += 1e-8
        np.divide(mean, by, out=by)
        by *= rate / (1 - 0.9 ** self.steps)
        self.flat -= by


def train(into: np.ndarray, class_: np.ndarray, counts: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Weights by Adam over the windows of the given documents, each window once."""
    w = start_weights(seed)
    share = (np.bincount(class_, minlength=CLASSES) + 0.5).reshape(GROUPS, MEMBERS)
    w["c"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    w["d"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    at, there, _ = windows(counts)
    order = np.random.default_rng(seed).permutation(len(at))[:WINDOWS]
    adam = Adam(w)
    steps = -(-len(order) // BATCH)
    for step in range(steps):
        part = order[step * BATCH:(step + 1) * BATCH]
        g = batch_gradient(w, np.where(there[part], into[at[part]], START), class_[at[part]], there[part])
        adam.step(g, RATE * (1 - step / steps))
    return {k: v.astype(np.float32) for k, v in w.items()}


class Scorer:
    """Log10 probabilities by the trained model, SCORED windows at a time."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w
        e, root = w["e"], np.float32(np.sqrt(WIDTH))
        # by input row: what asks; what answers, with a one whose weighted sum is the sum of the weights
        self.late = np.concatenate([e @ w["q"] / root, e @ w["r"] + w["b"]], axis=1)
        self.early = np.concatenate([e @ w["k"], e @ w["v"], np.ones((len(e), 1), np.float32)], axis=1)

    def __call__(self, into: np.ndarray, class_: np.ndarray, share: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """By document; the arrays are those of `sequences`, counts include the end.

        Inputs lie in blocks of STRIDE, a document begins a block. A window is a block and the one before, so windows
        are overlapping views of the same rows; that a document's first window sees the one before is undone.
        """
        number = -(-counts // STRIDE)
        begin = np.cumsum(number) - number + 1  # block 0 stands before the first document
        place = np.arange(len(into)) + np.repeat(begin * STRIDE - (np.cumsum(counts) - counts), counts)
        blocks = int(number.sum()) + 1
        x, y = np.full(blocks * STRIDE, START), np.zeros(blocks * STRIDE, np.int64)
        x[place], y[place] = into, class_
        first = np.zeros(blocks, bool)
        first[begin] = True
        out = np.zeros(blocks * STRIDE, np.float32)
        half, width = slice(CONTEXT - STRIDE, CONTEXT), self.early.shape[1]
        causal, distance = CAUSAL[half], DISTANCE[half]
        for low in range(1, blocks, SCORED):
            high = min(low + SCORED, blocks)
            own = slice(low * STRIDE, high * STRIDE)
            late = self.late.take(x[own], axis=0).reshape(-1, STRIDE, 2 * WIDTH)
            early = self.early.take(x[low * STRIDE - (CONTEXT - STRIDE):high * STRIDE], axis=0)
            step = early.strides[0]
            early = np.lib.stride_tricks.as_strided(early, (high - low, CONTEXT, width), (STRIDE * step, step, early.strides[1]))
            a = attend(late[:, :, :WIDTH] @ early[:, :, :WIDTH].transpose(0, 2, 1), self.w["far"], causal, distance)
            a[first[low:high], :, :CONTEXT - STRIDE] = 0
            seen = a @ early[:, :, WIDTH:]
            h = seen[:, :, :WIDTH] / np.maximum(seen[:, :, WIDTH:], np.float32(1e-30))
            h += late[:, :, WIDTH:]
            order, parts = grouped(y[own])
            target, row = y[own][order], np.arange(len(order))
            z = logits(self.w, np.tanh(h, out=h).reshape(-1, WIDTH).take(order, axis=0), parts)
            right = z[0, row, target // MEMBERS] + z[1, row, target % MEMBERS]
            np.exp(z, out=z)
            total = z.reshape(-1, MEMBERS) @ np.ones(MEMBERS, np.float32)
            out[low * STRIDE + order] = right - np.log(total[:len(order)] * total[len(order):])
        return np.add.reduceat((out[place] + share).astype(np.float64), np.cumsum(counts) - counts) / np.log(10)


def counted(docs: DataFrame) -> DataFrame:
    """(key, n) of the texts: words by hash and how often they occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for a, b in groups(offsets, 8 << 20):
                text, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                key, n = np.unique(np.concatenate([words(text[at[x]:at[y]], at[x:y + 1] - at[x])[0] for x, y in groups(at)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(key, held_out, size, ids) of documents (key, held_out, text): bytes of the text, its subword ids of two bytes each.

    Written once, so that a text is cut into subwords once, whatever learns from it or scores it later.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = subwords(path)
        for batch in batches:
            data, offsets = flat(batch.column(2))
            for a, b in groups(offsets, 1 << 20):
                ids, counts = tokenizer.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                ends = np.append(0, np.cumsum(counts * ids.itemsize)).astype(np.int32)
                lists = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(offsets[a:b + 1])), lists],
                    names=["key", "held_out", "size", "ids"])

    return materialize(docs.select("key", "held_out", "text").mapInArrow(run, "key long, held_out boolean, size long, ids binary"))


def id_groups(size: pa.Array | pa.ChunkedArray, ids: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of rows of `encoded`, those of about a megabyte of text at a time: first row, end, ids one after the other, number by row."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    ids = ids.cast(pa.large_binary())
    at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
    data = ids.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for a, b in groups(np.append(0, np.cumsum(size.to_numpy())), 1 << 20):
        yield a, b, data[at[a]:at[b]].view(np.uint16), np.diff(at[a:b + 1]) // 2


def counted_ids(known: DataFrame) -> DataFrame:
    """(id, n) of the documents' subword ids, and -1 with the number of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(VOCABULARY, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, ids, _ in id_groups(batch.column(0), batch.column(1)):
                total += np.bincount(ids, minlength=VOCABULARY)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(there, -1)), pa.array(np.append(total[there], rows))], names=["id", "n"])

    return known.select("size", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def fitted(docs: DataFrame, vocabulary: Vocabulary, path: str) -> dict[str, np.ndarray]:
    """Attention weights to start from: learned from a bounded sample of the documents in one task."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64(F.col("doc_id"), F.lit("lm")), "doc_id").limit(SAMPLE)
    at = F.xxhash64(F.col("doc_id"), F.lit("lm")).alias("at")
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text")).select(at, "doc_id", "text")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["at", "doc_id"])
        tokenizer, ids, counts = subwords(path), [], []
        data, offsets = flat(pa.array(part["text"], pa.string()))
        for a, b in groups(offsets):
            i, c = tokenizer.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            ids.append(i)
            counts.append(c)
        counts = np.concatenate(counts)
        into, class_, _ = sequences(np.concatenate(ids), counts, vocabulary)
        w = train(into, class_, counts + 1)
        return pd.DataFrame({"name": list(w), "weights": [v.tobytes() for v in w.values()]})

    rows = sample.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(run, "name string, weights binary").collect()
    start = start_weights()
    return start | {r.name: np.frombuffer(r.weights, np.float32).reshape(start[r.name].shape) for r in rows}


def covering(counts: np.ndarray) -> np.ndarray:
    """Of the windows of such documents, every other one and a document's last: together they see all inputs."""
    number = -(-counts // STRIDE)
    step = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    return np.flatnonzero((step % 2 == 1) | (step == np.repeat(number, number) - 1))


def averaged(group: pa.Table) -> pa.Table:
    """Sums of the weights of some shards, and of their numbers of inputs."""
    group = group.sort_by("part")
    total = np.sum([np.frombuffer(x.as_py(), np.float64) for x in group.column("weights")], axis=0)
    n = sum(group.column("inputs").to_pylist())
    return pa.table({"part": [group.column("part")[0].as_py() // FAN], "inputs": [n], "weights": [total.tobytes()]})


def learned_from_all(known: DataFrame, weights: dict[str, np.ndarray], vocabulary: Vocabulary, inputs: int) -> dict[str, np.ndarray]:
    """The weights, having seen each of so many inputs of all documents (of `encoded`): rounds of a pass in each shard, then the average.

    Shards follow from the documents and the number of inputs alone, and rows are taken in the order of their hash, so
    the weights don't depend on partitions. Rows equal in doc_id and text (the key) teach once; they are made one before
    they travel. A shard counts by its number of inputs. Only sums of weights move on, FAN of them in a task at a time.
    """
    spark = known.sparkSession
    shards = max(1, -(-inputs // (SHARD * len(ROUNDS))))

    def passed(model, rate: float):
        def run(shard: pa.Table) -> pa.Table:
            vocabulary, start = model.value
            w = {k: v.copy() for k, v in start.items()}
            adam, random, inputs = Adam(w), np.random.default_rng(11), 0
            shard = shard.sort_by("key")
            for _, _, i, c in id_groups(shard.column("size"), shard.column("ids")):
                into, class_, _ = sequences(i, c, vocabulary)
                order = random.permutation(covering(c + 1))
                at, there, _ = windows(c + 1, order)
                for first in range(0, len(order), LOCAL_BATCH):
                    part = slice(first, first + LOCAL_BATCH)
                    g = batch_gradient(w, np.where(there[part], into[at[part]], START), class_[at[part]], there[part])
                    # a batch that is not full moves the weights less
                    adam.step(g, rate * len(there[part]) / LOCAL_BATCH)
                inputs += len(into)
            flat_weights = np.concatenate([v.ravel() for v in w.values()]).astype(np.float64) * inputs
            return pa.table({"part": shard.column("shard").slice(0, 1), "inputs": [inputs], "weights": [flat_weights.tobytes()]})
        return run

    for number, rate in enumerate(ROUNDS):
        model = spark.sparkContext.broadcast((vocabulary, weights))
        own = known.where(F.pmod(F.xxhash64("key", F.lit("round")), F.lit(len(ROUNDS))) == number)
        own = own.groupBy("key").agg(F.max("size").alias("size"), F.max("ids").alias("ids"))
        own = own.select(F.pmod("key", F.lit(shards)).cast("long").alias("shard"), "key", "size", "ids").repartition(min(shards, TASKS), "shard")
        sums = own.groupBy("shard").applyInArrow(passed(model, rate), "part long, inputs long, weights binary")
        left = shards
        while left > 1:
            sums = sums.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(averaged, sums.schema)
            left = -(-left // FAN)
        rows = sorted(sums.collect(), key=lambda r: r.part)
        if not rows:
            continue
        total = np.sum([np.frombuffer(r.weights, np.float64) for r in rows], axis=0) / sum(r.inputs for r in rows)
        cuts = np.cumsum([v.size for v in weights.values()])[:-1]
        weights = {k: x.reshape(v.shape).astype(np.float32) for (k, v), x in zip(weights.items(), np.split(total, cuts), strict=True)}
    return weights


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the most frequent words: all with a count from some power of two on."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("size")).agg(F.count(F.lit(1)).alias("words"))
    least, held = 64, 0
    for r in sorted(by_size.collect(), key=lambda r: -r.size):
        held += r.words
        if held > most:
            break
        least = r.size
    table = counts.where(F.floor(F.log2("n")) >= least).select("key", "n").toArrow()
    key = table.column(0).to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], table.column(1).to_numpy()[order]


class Places:
    """`searchsorted` of hashes: from the place where those with the same first bits begin, a few steps on."""

    def __init__(self, known: np.ndarray):
        self.known, bits = np.append(known, np.uint64(2**64 - 1)), max(1, len(known).bit_length())
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def __call__(self, word: np.ndarray) -> np.ndarray:
        at = self.begin[(word >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.known[at] < word)
        while len(behind):
            at[behind] += 1
            behind = behind[self.known[at[behind]] < word[behind]]
        return at


def language_scores(docs: DataFrame, path: str, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Takes doc_id and text; other columns are ignored. `held_out` is a condition on doc_id: documents for which
    it is true are not learned from. Tokens are the words between white space, A-Z lower-cased, and one end a
    document; base_score is the sum of log10((c + 0.5) / (N + 0.5 * (V + 1))). `score` is the log10 probability
    of the text's subword ids and end by the attention model, which learns from all training documents, as do
    its class shares; it doesn't depend on how rows lie in partitions. Null and empty texts are one end. Equal rows have
    a line each with the same score; no rows give no rows; if nothing may be learned from, counts are zero and the model's
    weights are the starting ones.

    Words, and documents of (doc_id, text), are told apart by 64-bit hashes; a scan must give the same rows each time.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumns({"held_out": F.coalesce(held_out, F.lit(False)), "key": F.xxhash64("doc_id", F.coalesce("text", F.lit("")))})
    learned = rows.where(~F.col("held_out"))
    by_word = materialize(counted(learned))
    known = encoded(rows, path)
    known_learned = known.where(~F.col("held_out"))
    told = {r.id: r.n for r in counted_ids(known_learned).collect()}
    ends = told.pop(-1, 0)
    total = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, distinct = total.n + ends, total.v + (ends > 0)
    ids = np.zeros(VOCABULARY)
    for id_, n in told.items():
        ids[id_] = n
    vocabulary = Vocabulary.of(ids)
    weights = learned_from_all(known_learned, fitted(learned, vocabulary, path), vocabulary, int(ids.sum()) + ends)
    below = n_train + 0.5 * (distinct + 1)
    table = spark.sparkContext.broadcast(frequent(by_word, FREQUENT))
    model = spark.sparkContext.broadcast((vocabulary, weights))

    def modelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = model.value
        scorer = Scorer(weights)
        for batch in batches:
            for a, b, i, c in id_groups(batch.column(1), batch.column(2)):
                score = scorer(*sequences(i, c, vocabulary), c + 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score)], names=["k", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_n = table.value
        places = Places(known)
        value = np.log10((known_n + 0.5) / below)
        end_value = np.log10((ends + 0.5) / below)
        for batch in batches:
            data, offsets = flat(batch.column(4))
            for a, b in groups(offsets, 1 << 20):
                text, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                word, row, _ = words(text, at)
                spot = np.minimum(places(word), max(len(known) - 1, 0))
                hit = known[spot] == word if len(known) else np.zeros(len(word), bool)
                total = np.bincount(row[hit], weights=value[spot[hit]], minlength=b - a) + end_value
                seen = np.bincount(row[hit], minlength=b - a) + (ends > 0)
                own, key = (batch.column(i).slice(a, b - a).to_numpy() for i in (0, 3))
                doc = pa.StructArray.from_arrays([
                    batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a),
                    pa.array(np.bincount(row, minlength=b - a) + 1), pa.array(seen.astype(np.int64)), pa.array(total)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base"])
                # words that are not frequent, once a document
                rare, rare_row = word[~hit], row[~hit]
                order = np.lexsort((rare, rare_row))
                rare, rare_row = rare[order], rare_row[order]
                new = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (rare_row[1:] != rare_row[:-1])])) if len(rare) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(rare)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([own, own[rare_row[new]]])), pa.array(np.concatenate([key, rare[new].view(np.int64)])),
                    pa.array(np.concatenate([np.zeros(b - a, np.int64), times])), pa.concat_arrays([doc, pa.nulls(len(new), doc.type)])],
                    names=["row", "hash", "times", "doc"])

    parts = rows.select("row", "doc_id", "held_out", "key", "text").mapInArrow(
        run, "row long, hash long, times long, doc struct<doc_id:long,held_out:boolean,n_tokens:long,n_known:long,base:double>")
    none = F.lit(None)
    c = by_word.select(F.col("key").alias("k"), F.col("n").alias("c"), none.cast("double").alias("score"))
    models = known.select("key", "size", "ids").mapInArrow(modelled, "k long, score double").groupBy("k").agg(F.max("score").alias("score"))
    c = c.unionAll(models.select("k", none.cast("long").alias("c"), "score"))
    # a document's own line meets the model's score of its key, all other lines the count of their word
    joined = parts.join(c, (F.col("hash") == F.col("k")) & ((F.col("times") > 0) == F.col("c").isNotNull()), "left")
    rare = F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(below))
    scored = joined.select("row", "doc", "score", F.when(F.col("times") > 0, rare).otherwise(0.0).alias("rare"),
                           F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).alias("met"))
    out = scored.groupBy("row").agg(
        *(F.max(f"doc.{name}").alias(name) for name in ("doc_id", "held_out", "n_tokens", "n_known", "base")),
        F.max("score").alias("score"), F.sum("rare").alias("rare"), F.sum("met").alias("met"))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("met")).alias("n_known"),
                      F.lit(int(n_train)).cast("long").alias("train_tokens"), (F.col("base") + F.col("rare")).alias("base_score"), "score")

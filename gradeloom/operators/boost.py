"""Boosted trees grown leaf by leaf from histograms, with penalties on leaf values and trees left out by turns."""

from __future__ import annotations

import heapq
import pickle
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gradeloom.operators.trees import Forest, TreeModel, matrix
from gradeloom.schema import FEATURES
from gradeloom.session import materialize, send_package

#: Cuts of a feature are taken at so many even shares of its values at most.
BINS = 64
#: Gradients are summed as whole numbers of this fraction, so a sum is the same in any order and on any cluster.
UNIT = 1 << 20
#: Leaves whose children are counted in one pass, though perhaps not all of them will be split.
AHEAD = 8
#: Binned rows up to which all passes of a fit run in one task: there a job a pass costs far more than what it sums.
ONE_TASK = 1 << 17
#: Values that are put together to be summed at once.
AT_ONCE = 1 << 20

LOGISTIC, HINGE = "logistic", "hinge"


@dataclass
class Options:
    trees: int = 20
    leaves: int = 31
    depth: int = 30
    leaf_rows: int = 1
    rate: float = 0.1
    columns: float = 1.0  # share of the features a tree may use
    l1: float = 0.0
    l2: float = 1.0
    least_gain: float = 0.0
    drop: float = 0.0  # odds of an earlier tree to be left out while a tree is grown
    objective: str = LOGISTIC
    bins: int = BINS  # at most so many cuts of a feature

    @classmethod
    def of(cls, params: dict) -> Options:
        known = {k: type(getattr(cls, k))(params[k]) for k in cls.__dataclass_fields__ if params.get(k) is not None and k != "columns"}
        if params.get("columns") is not None:
            known["columns"] = 1.0 if params["columns"] == "all" else float(params["columns"])
        return cls(**known)


def cut_points(rows: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Of each feature, values that rows are parted at, in order. All values below the largest, if there are few.

    A feature is a key, so that their sketches are merged side by side and no task holds those of all features.
    """
    shares = F.array(*(F.lit(i / bins) for i in range(bins)))
    values = F.array(*(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features))
    long = rows.select(F.posexplode(values).alias("f", "x")).where("x is not null")
    found = {r.f: r for r in long.groupBy("f").agg(F.percentile_approx("x", shares, 100000).alias("at"), F.max("x").alias("most")).collect()}
    return [np.unique([v for v in found[i].at if v < found[i].most]) if i in found else np.zeros(0) for i in range(len(features))]


def binned(rows: DataFrame, features: list[str], cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: (bins, target, weight, margin), packed. A value's bin is the number of cuts below it; missing is last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, features)
            at = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)
            y = batch.column("target").cast(pa.int8()).to_numpy()
            w = batch.column("weight").cast(pa.float64()).to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array([v.tobytes()], pa.binary()) for v in (at, y, w, np.zeros(len(y)))], names=["bins", "target", "weight", "margin"])

    return rows.select(*features, "target", "weight").mapInArrow(run, "bins binary, target binary, weight binary, margin binary")


def blocks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for i in range(batch.num_rows):
            bins, y, w, margin = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in enumerate((np.uint8, np.int8, np.float64, np.float64)))
            if len(y):
                yield bins.reshape(features, -1), y, w, margin


@dataclass
class Node:
    """A node of the tree being grown; a leaf has the feature -1."""

    feature: int = -1
    bin: int = -1  # rows up to this bin go left
    left: int = -1
    right: int = -1
    value: float = 0.0
    weight: float = 0.0
    depth: int = 0


def leaves_of(nodes: list[Node], bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(bins.shape[1], np.int64)
    for number, node in enumerate(nodes):  # children have larger numbers than their parent
        if node.feature >= 0:
            here = np.flatnonzero(at == number)
            at[here] = np.where(bins[node.feature, here] <= node.bin, node.left, node.right)
    return at


def contribution(tree: list[Node], bins: np.ndarray) -> np.ndarray:
    return np.array([n.value for n in tree])[leaves_of(tree, bins)]


def slopes(objective: str, y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Gradient, curvature and weight of each row as whole numbers, and ones."""
    if objective == HINGE:
        sign = np.where(y > 0, 1.0, -1.0)
        g, h = np.where(sign * margin < 1, -sign, 0.0) * w, w
    else:
        p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        g, h = (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w
    return np.stack([np.rint(g * UNIT), np.rint(h * UNIT), np.rint(w * UNIT), np.ones(len(y))]).astype(np.int64)


def whole_sums(key: np.ndarray, what: np.ndarray, count: int) -> np.ndarray:
    """Sums of whole numbers by key. Those of a task stay below 2 to the power 53, so doubles hold them exactly."""
    return np.bincount(key, what, count).astype(np.int64)


def histograms(state: DataFrame, features: int, tree: list[Node], wanted: list[int], dropped: list[list[Node]], objective: str) -> dict[int, np.ndarray]:
    """For each wanted leaf, sums by (what is summed, feature, bin): gradient, curvature, weight and rows.

    Tasks sum their blocks, the sums are added by key before and behind the shuffle, and what comes to the driver is
    a few thousand numbers a leaf, however many rows there are.
    """
    held = state.sparkSession.sparkContext.broadcast((tree, dropped))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree_, dropped_ = held.value
        total = np.zeros((len(wanted), 4, features, 256), np.int64)
        place = np.full(len(tree_), -1)
        place[wanted] = np.arange(len(wanted))
        for bins, y, w, margin in blocks(batches, features):
            for other in dropped_:
                margin = margin - contribution(other, bins)
            own = place[leaves_of(tree_, bins)]
            inside = np.flatnonzero(own >= 0)
            if not len(inside):
                continue
            what = slopes(objective, y[inside], w[inside], margin[inside])
            for f in range(features):
                key = own[inside] * 256 + bins[f, inside]
                for k in range(4):
                    total[:, k, f] += whole_sums(key, what[k], len(wanted) * 256).reshape(-1, 256)
        leaf, f, b = np.nonzero(total[:, 3])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (leaf, f, b, *(total[leaf, k, f, b] for k in range(4)))], names=["leaf", "f", "b", "g", "h", "w", "n"])

    ddl = "leaf long, f long, b long, g long, h long, w long, n long"
    summed = state.mapInArrow(run, ddl).groupBy("leaf", "f", "b").agg(*(F.sum(c).alias(c) for c in "ghwn")).toArrow()
    out = np.zeros((len(wanted), 4, features, 256), np.int64)
    leaf, f, b = (summed.column(c).to_numpy() for c in ("leaf", "f", "b"))
    for k, c in enumerate("ghwn"):
        out[leaf, k, f, b] = summed.column(c).to_numpy()
    held.unpersist()
    return dict(zip(wanted, out, strict=True))


def shrunk(g, l1: float):
    """A gradient sum less the penalty on absolute leaf values."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_split(sums: np.ndarray, options: Options, allowed: np.ndarray) -> tuple[float, int, int] | None:
    """Gain, feature and bin of a leaf's best split; the first feature and bin of equal ones. None if there is none."""
    left = np.cumsum(sums, axis=2)
    right = left[:, :, -1:] - left
    worth = lambda g, h: shrunk(g / UNIT, options.l1) ** 2 / (h / UNIT + options.l2 + 1e-12)
    gain = 0.5 * (worth(left[0], left[1]) + worth(right[0], right[1]) - worth(left[0, :, -1:], left[1, :, -1:]))
    fits = (left[3] >= max(1, options.leaf_rows)) & (right[3] >= max(1, options.leaf_rows)) & allowed[:, None]
    gain = np.where(fits, gain, -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    return None if not gain[f, b] > max(options.least_gain, 1e-12) else (float(gain[f, b]), f, b)


def leaf_value(sums: np.ndarray, options: Options) -> float:
    g, h = sums[0, 0].sum() / UNIT, sums[1, 0].sum() / UNIT
    return float(-options.rate * shrunk(g, options.l1) / (h + options.l2 + 1e-12))


def grown(count: Callable[[list[Node], list[int]], dict[int, np.ndarray]], options: Options, allowed: np.ndarray) -> list[Node]:
    """One tree, always split next at the leaf that gains most. `count` gives the sums of some leaves of a tree.

    Only the smaller child of a split is counted, its sibling is the parent less it. Children of the AHEAD best leaves
    are counted in one pass, so a tree takes far fewer passes than it has leaves.
    """
    nodes = [Node()]
    sums = count(nodes, [0])
    waiting: list[tuple[float, int]] = []  # (-gain, node) of leaves that can be split
    ready: dict[int, tuple[float, int, int]] = {}

    def weigh(number: int) -> None:
        nodes[number].value = leaf_value(sums[number], options)
        nodes[number].weight = float(sums[number][2, 0].sum() / UNIT)
        found = best_split(sums[number], options, allowed) if nodes[number].depth < options.depth else None
        if found is not None:
            ready[number] = found
            heapq.heappush(waiting, (-found[0], number))

    weigh(0)
    leaves, counted = 1, {}  # counted: node -> sums of its two children, not yet hung below it
    while waiting and leaves < options.leaves:
        if waiting[0][1] not in counted:
            ahead = [n for _, n in heapq.nsmallest(min(AHEAD, options.leaves - leaves), waiting) if n not in counted]
            trial, small = [Node(**vars(n)) for n in nodes], {}
            for number in ahead:
                _, f, b = ready[number]
                trial[number].feature, trial[number].bin = f, b
                trial[number].left, trial[number].right = len(trial), len(trial) + 1
                trial += [Node(), Node()]
                goes_left = sums[number][3, f, :b + 1].sum()
                small[number] = trial[number].left if 2 * goes_left <= sums[number][3, f].sum() else trial[number].right
            got = count(trial, list(small.values()))
            for number, child in small.items():
                pair = (got[child], sums[number] - got[child])
                counted[number] = pair if child == trial[number].left else pair[::-1]
        _, number = heapq.heappop(waiting)
        _, f, b = ready.pop(number)
        parent = nodes[number]
        parent.feature, parent.bin, parent.left, parent.right = f, b, len(nodes), len(nodes) + 1
        del sums[number]
        for child in counted.pop(number):
            nodes.append(Node(depth=parent.depth + 1))
            sums[len(nodes) - 1] = child
            weigh(len(nodes) - 1)
        leaves += 1
    return nodes


def moved_on(state: DataFrame, features: int, tree: list[Node], dropped: list[list[Node]], keep: float) -> DataFrame:
    """The blocks with the new tree's values added to the margins and all but `keep` of the dropped ones' taken off."""
    held = state.sparkSession.sparkContext.broadcast((tree, dropped))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree_, dropped_ = held.value
        for bins, y, w, margin in blocks(batches, features):
            margin = margin + contribution(tree_, bins)
            for other in dropped_:
                margin = margin - (1 - keep) * contribution(other, bins)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (bins, y, w, margin)], names=["bins", "target", "weight", "margin"])

    return materialize(state.mapInArrow(run, state.schema))


def scaled(tree: list[Node], by: float) -> list[Node]:
    return [Node(**{**vars(n), "value": n.value * by}) for n in tree]


def as_forest(trees: list[list[Node]], cuts: list[np.ndarray], objective: str) -> Forest:
    nodes, roots, shift = [], [], 0
    for tree in trees:
        roots.append(shift)
        nodes += [(n.feature, float(cuts[n.feature][n.bin]) if n.feature >= 0 else 0.0, n.left + shift, n.right + shift, n.value, n.weight) for n in tree]
        shift += len(tree)
    columns = list(zip(*nodes, strict=True)) if nodes else [()] * 6
    arrays = [np.array(c, t) for c, t in zip(columns, (np.int64, np.float64, np.int64, np.int64, np.float64, np.float64), strict=True)]
    return Forest(*arrays, np.array(roots, np.int64), 0.0, None if objective == HINGE else 1.0, objective == HINGE)


@dataclass
class Binned:
    """Training rows put into bins and packed, written once for all fits over them."""

    features: list[str]
    cuts: list[np.ndarray]
    state: DataFrame

    def count(self) -> int:
        return self.state.agg(F.sum(F.octet_length("target"))).first()[0] or 0  # a row has one byte


def into_bins(rows: DataFrame, features: list[str] = FEATURES, bins: int = BINS) -> Binned:
    """Rows of features, target and weight, without those that have no target; a missing weight column is 1 everywhere."""
    send_package(rows.sparkSession)
    weight = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    given = rows.where(F.col("target").isNotNull()).select(*features, F.col("target").cast("int").alias("target"), weight.alias("weight"))
    cuts = cut_points(given, features, min(bins, 255))
    return Binned(features, cuts, materialize(binned(given, features, cuts)))


class Spread:
    """Passes over blocks that lie anywhere on the cluster, a job each."""

    def __init__(self, state: DataFrame, features: int, objective: str):
        self.state, self.features, self.objective = state, features, objective

    def start(self, dropped: list[list[Node]]) -> None:
        self.dropped = dropped

    def sums(self, tree: list[Node], wanted: list[int]) -> dict[int, np.ndarray]:
        return histograms(self.state, self.features, tree, wanted, self.dropped, self.objective)

    def move_on(self, tree: list[Node], keep: float) -> None:
        self.state = moved_on(self.state, self.features, tree, self.dropped, keep)


class Held:
    """The same passes over the blocks of one task, which remembers each node's rows while a tree is grown."""

    def __init__(self, held: list[tuple[np.ndarray, ...]], features: int, width: int, objective: str):
        none = (np.zeros((features, 0), np.uint8), np.zeros(0, np.int8), np.zeros(0), np.zeros(0))
        self.bins, self.y, self.w, self.margin = (np.concatenate(part, axis=-1) for part in zip(none, *held, strict=True))
        self.features, self.width, self.objective = features, width, objective
        self.keys = self.bins.T + np.arange(features) * width

    def start(self, dropped: list[list[Node]]) -> None:
        self.dropped, margin = [contribution(other, self.bins) for other in dropped], self.margin
        for other in self.dropped:
            margin = margin - other
        self.what = slopes(self.objective, self.y, self.w, margin).astype(np.float64)
        self.rows = {0: np.arange(len(self.y))}

    def rows_of(self, tree: list[Node], parents: dict[int, int], number: int) -> np.ndarray:
        if number not in self.rows:
            self.rows[number] = self.side(tree, parents, number)
        return self.rows[number]

    def side(self, tree: list[Node], parents: dict[int, int], number: int) -> np.ndarray:
        parent, rows = tree[parents[number]], self.rows_of(tree, parents, parents[number])
        goes_left = self.bins[parent.feature, rows] <= parent.bin
        return rows[goes_left if parent.left == number else ~goes_left]

    def sums(self, tree: list[Node], wanted: list[int]) -> dict[int, np.ndarray]:
        parents = {child: i for i, n in enumerate(tree) if n.feature >= 0 for child in (n.left, n.right)}
        # only those above are remembered: children that are tried may yet get other numbers
        return {n: self.summed(self.side(tree, parents, n) if n else self.rows[0]) for n in wanted}

    def summed(self, rows: np.ndarray) -> np.ndarray:
        count, step = self.features * self.width, max(1, AT_ONCE // self.features)
        out = np.zeros((4, count), np.int64)
        for start in range(0, len(rows), step):
            some = rows[start:start + step]
            key = self.keys[some].ravel()
            for k in range(4):
                out[k] += whole_sums(key, np.repeat(self.what[k, some], self.features), count)
        return out.reshape(4, self.features, self.width)

    def move_on(self, tree: list[Node], keep: float) -> None:
        self.margin = self.margin + contribution(tree, self.bins)
        for other in self.dropped:
            self.margin = self.margin - (1 - keep) * other


def boosted(passes: Spread | Held, features: int, options: Options, seed: int) -> list[list[Node]]:
    """The trees of a fit, one after the other."""
    rng, trees = random.Random(seed), []
    for _ in range(options.trees):
        left_out = [i for i in range(len(trees)) if options.drop and rng.random() < options.drop]
        columns = sorted(rng.sample(range(features), max(1, round(options.columns * features))))
        passes.start([trees[i] for i in left_out])
        tree = scaled(grown(passes.sums, options, np.isin(np.arange(features), columns)), 1 / (len(left_out) + 1))
        keep = len(left_out) / (len(left_out) + 1)
        passes.move_on(tree, keep)
        for i in left_out:
            trees[i] = scaled(trees[i], keep)
        trees.append(tree)
    return trees


def fit_binned(rows: Binned, params: dict | None = None, seed: int = 0, one_task: int = ONE_TASK) -> TreeModel:
    """Boosted trees from rows put into bins before; the same as by `fit_leafwise` with as many bins.

    Up to `one_task` rows all passes run in one task, so that many fits of small tables go side by side; beyond, each
    pass is a job over the blocks. Either way sums are whole numbers, and the trees are the same.
    """
    options, features = checked(params), len(rows.features)
    if rows.count() > one_task:
        return model_of(boosted(Spread(rows.state, features, options.objective), features, options, seed), rows, options)
    width = max(map(len, rows.cuts), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = boosted(Held(list(blocks(batches, features)), features, width, options.objective), features, options, seed)
        # in plain tuples: the driver's classes need not be the task's
        plain = [[tuple(vars(n).values()) for n in tree] for tree in trees]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(plain)], pa.binary())], names=["trees"])

    (found,) = rows.state.repartition(1).mapInArrow(run, "trees binary").collect()
    return model_of([[Node(*n) for n in tree] for tree in pickle.loads(found.trees)], rows, options)


def checked(params: dict | None) -> Options:
    options = Options.of(params or {})
    if options.objective not in (LOGISTIC, HINGE):
        raise ValueError(f"unknown objective {options.objective!r}")
    return options


def model_of(trees: list[list[Node]], rows: Binned, options: Options) -> TreeModel:
    return TreeModel(as_forest(trees, rows.cuts, options.objective), rows.features)


def fit_leafwise(rows: DataFrame, features: list[str] = FEATURES, params: dict | None = None, seed: int = 0) -> TreeModel:
    """Boosted trees from rows of features, target (0 or 1) and weight; a missing weight column is 1 everywhere.

    Values are put into bins once and written with the margins in packed blocks; every tree takes a few passes over
    the blocks that sum gradients by leaf, feature and bin, and one that moves the margins on, written again so that
    no lineage builds up. Sums are whole numbers, so a fit is the same however the rows lie. Rows without a target
    are left out; missing values go right. With `drop`, each earlier tree is left out of a round with these odds; of k
    left out, the new tree gets the (k + 1)th part of its value and the others keep k of k + 1 parts. Without rows
    the model scores one half (hinge: 0).
    """
    options = checked(params)
    given = into_bins(rows, features, options.bins)
    return model_of(boosted(Spread(given.state, len(features), options.objective), len(features), options, seed), given, options)

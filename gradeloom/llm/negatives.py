"""Hard negatives: rows of other labels that score close below an anchor's positives, found in STR-packed R-trees."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.shipping import ship
from gradeloom.llm.vectors import matrix
from gradeloom.session import materialize

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Rows of a leaf and children of a node.
LEAF, FANOUT = 128, 8
#: A block, one task's tree, holds about BLOCK * sqrt(rows) rows, and meets up to ANCHORS times as many anchors at a time.
#: So blocks, whose boxes all tasks get, are only sqrt(rows) / BLOCK, whatever the table's size.
BLOCK, ANCHORS = 16, 4
#: Anchors whose bounds are worked out at a time.
BATCH = 256
#: Rounding of sums of products in double precision, as a share of the sum of their sizes.
ROUNDING = 1e-12


def wide(rows: np.ndarray, size: int) -> np.ndarray:
    """Rows filled up with zeros."""
    return rows if rows.shape[1] == size else np.pad(rows, ((0, 0), (0, size - rows.shape[1])))


def packed_leaves(rows: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Sort-tile-recursive: cut `at` into slabs along the widest coordinate, each slab along the next one, and so on."""
    widest = np.argsort(-rows[at].var(axis=0), kind="stable") if rows.shape[1] else np.zeros(0, np.int64)
    todo = [(at, 0)]
    while todo:
        part, level = todo.pop()
        leaves = -(-len(part) // LEAF)
        if leaves <= 1:
            yield part
            continue
        left = len(widest) - level
        slabs = leaves if left <= 1 else max(2, math.ceil(leaves ** (1 / left)))
        if left:
            part = part[np.argsort(rows[part, widest[level]], kind="stable")]
        step = -(-leaves // slabs) * LEAF
        todo += [(part[i:i + step], level + 1) for i in reversed(range(0, len(part), step))]


class Tree:
    """An R-tree for each label over whole-number vectors, all labels' nodes in one table of boxes."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = np.lexsort((ids, labels))
        leaves = [leaf for own in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1) for leaf in packed_leaves(rows, own)]
        order = np.concatenate(leaves)
        self.rows, self.ids = rows[order], ids[order]
        self.order = order
        ends = np.cumsum([len(x) for x in leaves])
        begins = ends - [len(x) for x in leaves]
        low = np.minimum.reduceat(self.rows, begins, axis=0)
        high = np.maximum.reduceat(self.rows, begins, axis=0)
        label = labels[order][begins]
        boxes, self.begin, self.end = [(low, high)], begins.tolist(), ends.tolist()
        self.leaves, first = len(leaves), 0
        while True:
            # neighbours of one label go below one node, until each label has one
            place = np.arange(len(label)) - np.searchsorted(label, label)
            if not place.any():
                break
            new = np.flatnonzero(place % FANOUT == 0)
            low, high, label = np.minimum.reduceat(low, new, axis=0), np.maximum.reduceat(high, new, axis=0), label[new]
            boxes.append((low, high))
            self.begin += (first + new).tolist()
            self.end += [*(first + new[1:]).tolist(), first + len(place)]
            first += len(place)
        self.roots = dict(zip(label.tolist(), range(first, first + len(label)), strict=True))
        self.low = np.concatenate([x for x, _ in boxes])
        self.high = np.concatenate([x for _, x in boxes])
        size = float(np.abs(self.rows).max(initial=0))
        self.exact = size * size * max(1, rows.shape[1])

    def scores(self, node: int, anchor: np.ndarray, whole: np.ndarray, exact: bool) -> np.ndarray:
        rows = self.rows[self.begin[node]:self.end[node]]
        return rows @ anchor if exact else rows.astype(np.int64) @ whole


def between(low: np.ndarray, high: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with anything in each box: the sum of each coordinate's interval."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    slack = (up - down) @ np.maximum(np.abs(low), np.abs(high)).T * ROUNDING
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


class Best:
    """The first `count` by score, then smaller id; nothing below `floor` is wanted."""

    def __init__(self, count: int, floor: float, ceiling: float = math.inf):
        self.count, self.floor, self.ceiling = count, floor, ceiling
        self.heap: list[tuple[int, int, int]] = []

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.floor) & (scores <= self.ceiling))
        if len(good) > self.count:
            good = good[np.lexsort((ids[good], -scores[good]))[:self.count]]
        for score, own in zip(scores[good].tolist(), ids[good].tolist(), strict=True):
            item = (int(score), -own)
            if len(self.heap) < self.count:
                heapq.heappush(self.heap, item)
            else:
                heapq.heappushpop(self.heap, item)
        if len(self.heap) == self.count:
            self.floor = max(self.floor, self.heap[0][0])  # the kth; equal ones may still have a smaller id

    def found(self) -> list[tuple[int, int]]:
        return [(score, -own) for score, own in sorted(self.heap, reverse=True)]


def search(tree: Tree, roots: list[int], wanted: list[Best], below: list[float], above: list[float], score: Callable, skip: int) -> None:
    """Best-first through the trees: the box that may hold the greatest score comes next.

    `below` and `above` are the nodes' bounds. A box goes if every wanted list's window lies outside its bounds, or
    its kth strictly above them. The row numbered `skip` is the anchor itself.
    """
    queue = [(-above[r], r) for r in roots]
    heapq.heapify(queue)
    while queue:
        top, node = heapq.heappop(queue)
        open_ = [w for w in wanted if -top >= w.floor and below[node] <= w.ceiling]
        if not open_:
            if all(-top < w.floor for w in wanted):
                return  # so are all that follow
            continue
        begin, end = tree.begin[node], tree.end[node]
        if node >= tree.leaves:
            for child in range(begin, end):
                heapq.heappush(queue, (-above[child], child))
            continue
        scores, ids = score(node), tree.ids[begin:end]
        if begin <= skip < end:
            keep = np.arange(begin, end) != skip
            scores, ids = scores[keep], ids[keep]
        for w in open_:
            w.offer(scores, ids)


def searched(tree: Tree, anchors: np.ndarray, task: Callable[[int], tuple[list[int], list[Best], int]]) -> Iterator[tuple[int, list[Best]]]:
    """Each anchor's number and wanted lists, filled from the tree; `task` gives roots, wanted lists and the row to skip."""
    largest = np.abs(anchors).max(axis=1, initial=0) * np.abs(tree.rows).max(initial=0) * max(1, anchors.shape[1])
    for first in range(0, len(anchors), BATCH):
        part = anchors[first:first + BATCH]
        below, above = between(tree.low, tree.high, part)
        for i in range(len(part)):
            roots, wanted, skip = task(first + i)
            if roots and wanted:
                exact, anchor, whole = largest[first + i] < 2**53, part[i], part[i].astype(np.int64)
                score = lambda node: tree.scores(node, anchor, whole, exact)  # noqa: B023, E731
                search(tree, roots, wanted, below[i].tolist(), above[i].tolist(), score, skip)
            yield first + i, wanted


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(coordinate, n, total, squares) of a batch's vectors."""
    for batch in batches:
        rows, _ = matrix(batch.column(0))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(rows.shape[1])), pa.array(np.full(rows.shape[1], len(rows))),
            pa.array(rows.sum(axis=0)), pa.array((rows * rows).sum(axis=0))], names=["coordinate", "n", "total", "squares"])


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """The rows with the number of their block: STR tiles along the two widest coordinates, too large ones cut by id.

    Equal vectors fall into one tile, so cutting by a hash of the id is what splits a large group of copies.
    """
    count = rows.count()
    sums = rows.select("vector").mapInArrow(spread, "coordinate long, n long, total double, squares double")
    sums = sums.groupBy("coordinate").agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("squares").alias("q"))
    widest = [r[0] for r in sums.orderBy(F.desc(F.col("q") - F.col("t") * F.col("t") / F.col("n")), "coordinate").limit(2).collect()]
    tiles = max(1, -(-count // size))
    slabs = math.ceil(math.sqrt(tiles))
    along = [F.coalesce(F.get("vector", F.lit(c)), F.lit(0.0)) for c in (widest + [0, 0])[:2]]
    rows = rows.withColumn("x", along[0]).withColumn("y", along[1])

    def cuts(parts: int, of: str) -> Column:
        return F.percentile_approx(of, F.array(*(F.lit(i / parts) for i in range(1, parts))), 10000) if parts > 1 else F.array().cast("array<double>")

    x_cuts = rows.agg(cuts(slabs, "x").alias("c")).first()["c"] or []
    number = lambda bounds, value: F.size(F.filter(bounds, lambda b: b < value))
    rows = rows.withColumn("slab", number(F.array(*map(F.lit, x_cuts)).cast("array<double>"), F.col("x")))
    y_cuts = rows.groupBy(F.col("slab").alias("s")).agg(cuts(-(-tiles // slabs), "y").alias("cuts"))
    rows = rows.join(y_cuts, F.col("slab") == F.col("s")).withColumn("tile", number(F.col("cuts"), F.col("y")))
    sizes = rows.groupBy(F.col("slab").alias("s"), F.col("tile").alias("t")).agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    rows = rows.drop("s").join(sizes, (F.col("slab") == F.col("s")) & (F.col("tile") == F.col("t")))
    block = (F.col("slab") * slabs + F.col("tile")).cast("long") * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("parts"))
    return rows.withColumn("block", block).drop("x", "y", "slab", "tile", "s", "t", "cuts", "parts")


FOUND = "anchor long, place int, id long, score long"


def table(rows: list[tuple]) -> pa.Table:
    kinds = [("anchor", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], names=[n for n, _ in kinds])


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, scale: int = SCALE, id_: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows that `anchors` is true of.

    Components are multiplied by `scale` and rounded down, a score is the whole-number inner product with the anchor,
    higher first, then the smaller id. An anchor's positives are its first other rows of the same label. To each, the
    first rows of other labels whose score lies between `low` and `high` hundredths of the positive's are returned.

    Rows are dealt to blocks of near vectors, each a task with an STR-packed R-tree by label. An anchor asks its own
    block first, then the blocks whose box may hold a score as high as its kth; for negatives it asks all blocks whose
    box meets one of its windows. Inside a block a best-first queue does the same with the nodes' boxes. Nothing is
    approximate. In many dimensions boxes are wide, so that most blocks are asked and work grows as anchors times
    rows; an anchor travels once a block, of which there are sqrt(rows) / BLOCK.

    Rows without id, label or vector, with a null or non-finite component, or whose squared length passes 2**62 (scores
    would pass 64 bits) take no part. Repeated rows are rows of their own, also as anchors; components that a shorter
    vector lacks count as zero. Anchors without positives, and positives without rows in the window, give no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    value = F.transform(F.col(column).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    given = F.col(column).cast("array<double>")
    fine = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.aggregate(F.transform(given, lambda x: x * scale), F.lit(0.0), lambda a, x: a + (F.abs(x) + 1) * (F.abs(x) + 1))
    rows = vectors.where(F.col(id_).isNotNull() & F.col(label).isNotNull() & fine & (length < float(2**62))).select(
        F.col(id_).cast("long").alias("id"), F.col(label).cast("long").alias("label"), value.alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asks"))
    count = rows.count()
    size = max(1, math.ceil(BLOCK * math.sqrt(count)))
    rows = materialize(blocks(rows, size).withColumn("row", F.monotonically_increasing_id()))
    asking = rows.where("asks").select(F.col("row").alias("anchor"), F.col("label").alias("own"), F.col("vector").alias("q"), F.col("block").alias("home"))
    groups = max(1, math.ceil(asking.count() / (size * ANCHORS)))

    def at_home(block: pa.Table) -> pa.Table:
        """The block's box, and its anchors' best positives there."""
        points, _ = matrix(block.column("vector").combine_chunks())
        ids, labels, numbers, asks = (block.column(c).to_numpy() for c in ("id", "label", "row", "asks"))
        tree = Tree(points, ids, labels)
        place = np.empty(len(ids), np.int64)
        place[tree.order] = np.arange(len(ids))
        own = np.flatnonzero(asks)
        out = []
        for i, (best,) in searched(tree, points[own], lambda i: ([tree.roots[labels[own[i]]]], [Best(positives, -math.inf)], place[own[i]])):
            out += [(numbers[own[i]], -1, found, score) for score, found in best.found()]
        found = table(out)
        box = pa.table({"low": [points.min(axis=0).tolist()], "high": [points.max(axis=0).tolist()]})
        none = pa.nulls(found.num_rows, pa.list_(pa.float64()))
        head = pa.table({"anchor": pa.nulls(1, pa.int64()), "place": pa.nulls(1, pa.int32()), "id": block.column("block").slice(0, 1), "score": pa.nulls(1, pa.int64())})
        return pa.concat_tables([head.append_column("low", box["low"]).append_column("high", box["high"]),
                                 found.append_column("low", none).append_column("high", none)])

    first = materialize(rows.groupBy("block").applyInArrow(at_home, FOUND + ", low array<double>, high array<double>"))
    boxes = first.where("anchor is null").select("id", "low", "high").toPandas()
    dims = max((len(x) for x in boxes["low"]), default=0)
    filled = lambda lists: np.array([[*x, *[0.0] * (dims - len(x))] for x in lists]).reshape(len(lists), dims)
    lows, highs = filled(boxes["low"]), filled(boxes["high"])
    # a block of shorter vectors has zeros in the coordinates it lacks
    held = spark.sparkContext.broadcast((boxes["id"].to_numpy(np.int64), lows, highs))

    def asked(askers: DataFrame) -> DataFrame:
        """(block, part, anchor, own, q, scores, place) for each block whose box may hold what (anchor, own, q, home, scores) wants."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, low_, high_ = held.value
            for batch in batches:
                for begin in range(0, batch.num_rows, BATCH):
                    part = batch.slice(begin, BATCH)
                    points, _ = matrix(part.column(2))
                    below, above = between(low_, high_, wide(points, low_.shape[1]))
                    home, scores = part.column(3).to_numpy(), part.column(4).to_pylist()
                    meets = np.zeros(below.shape, bool)
                    for i, own in enumerate(scores):
                        if home[i] >= 0:  # for positives: elsewhere, and not strictly below the kth
                            meets[i] = (numbers != home[i]) & (above[i] >= (min(own) if len(own) == positives else -math.inf))
                        for s in own if home[i] < 0 else []:
                            meets[i] |= (above[i] >= -(-low * s // 100)) & (below[i] <= high * s // 100)
                    who, where = np.nonzero(meets)
                    who = pa.array(who)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers[where]), *(part.column(c).take(who) for c in (0, 1, 2, 4))],
                        names=["block", "anchor", "own", "q", "scores"])

        out = askers.select("anchor", "own", "q", "home", "scores").mapInArrow(
            run, "block long, anchor long, own long, q array<double>, scores array<long>")
        return out.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int"))

    def answered(visits: DataFrame, wants: Callable) -> DataFrame:
        """What blocks have for the anchors that ask them."""
        def run(block: pa.Table, askers: pa.Table) -> pa.Table:
            if not block.num_rows or not askers.num_rows:
                return table([])
            points, _ = matrix(block.column("vector").combine_chunks())
            q, _ = matrix(askers.column("q").combine_chunks())
            dims = max(points.shape[1], q.shape[1])
            tree = Tree(wide(points, dims), block.column("id").to_numpy(), block.column("label").to_numpy())
            own, scores = askers.column("own").to_numpy(), askers.column("scores").to_pylist()
            numbers = askers.column("anchor").to_numpy()
            out = []
            for i, lists in searched(tree, wide(q, dims), lambda i: (*wants(tree, own[i], scores[i]), -1)):
                out += [(numbers[i], place, found, score) for place, best in enumerate(lists) for score, found in best.found()]
            return table(out)

        held_rows = rows.select("block", "id", "label", "vector", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
        return held_rows.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInArrow(run, FOUND)

    def same(tree: Tree, own: int, scores: list[int]) -> tuple[list[int], list[Best]]:
        floor = min(scores) if len(scores) == positives else -math.inf
        return [tree.roots[own]] if own in tree.roots else [], [Best(positives, floor)]

    def others(tree: Tree, own: int, scores: list[int]) -> tuple[list[int], list[Best]]:
        return [r for l, r in tree.roots.items() if l != own], [Best(negatives, -(-low * s // 100), high * s // 100) for s in scores]

    def best(df: DataFrame, by: list[str], number: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)

    near = first.where("anchor is not null").select("anchor", "place", "id", "score")
    scores = near.groupBy(F.col("anchor").alias("a")).agg(F.collect_list("score").alias("scores"))
    askers = asking.join(scores, F.col("anchor") == F.col("a"), "left").withColumn("scores", F.coalesce("scores", F.array().cast("array<long>")))
    chosen = best(near.unionAll(answered(asked(askers), same)), ["anchor"], positives)
    chosen = materialize(chosen.select("anchor", F.col("rank").alias("number"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    windows = chosen.groupBy(F.col("anchor").alias("a")).agg(F.sort_array(F.collect_list(F.struct("number", "positive_score"))).alias("w"))
    askers = asking.join(windows, F.col("anchor") == F.col("a")).withColumn("scores", F.col("w.positive_score")).withColumn("home", F.lit(-1).cast("long"))
    found = best(answered(asked(askers), others), ["anchor", "place"], negatives)
    names = rows.where("asks").select(F.col("row").alias("r"), F.col("id").alias("anchor_id"))
    found = found.withColumnRenamed("anchor", "a").join(chosen, (F.col("a") == F.col("anchor")) & (F.col("place") + 1 == F.col("number")))
    return found.join(names, F.col("a") == F.col("r")).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

"""Fitted decision trees as arrays: scores of many models in one pass, and what each feature adds to a score."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from gradeloom.operators.evaluate import mean_magnitude, ranked_importance
from gradeloom.schema import FEATURES
from gradeloom.session import fresh_folder, send_package

#: Rows taken through the trees at a time.
ROWS = 4096


@dataclass
class Forest:
    """Trees whose leaf values add up to a margin. All nodes lie in one table; a leaf has the feature -1.

    A row goes left where its feature is at most the threshold, so a missing value goes right. `cover` is the
    weight of the training rows that reached a node. With `slope` the probability is the logistic function of
    slope * margin; without, the margin is the probability itself; with `step` it is 1 above 0 and 0 elsewhere.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    roots: np.ndarray
    base: float = 0.0
    slope: float | None = None
    step: bool = False

    def leaf_of(self, root: int, x: np.ndarray) -> np.ndarray:
        """The leaf of one tree that each row of a matrix falls into."""
        node = np.full(len(x), root)
        on_way = np.arange(len(x)) if self.feature[root] >= 0 else np.zeros(0, np.int64)
        while len(on_way):
            at = node[on_way]
            goes_left = x[on_way, self.feature[at]] <= self.threshold[at]
            node[on_way] = at = np.where(goes_left, self.left[at], self.right[at])
            on_way = on_way[self.feature[at] >= 0]
        return node

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for root in self.roots.tolist():
            total += self.value[self.leaf_of(root, x)]
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        margin = self.margins(x)
        if self.step:
            return (margin > 0).astype(np.float64)
        return margin if self.slope is None else 1 / (1 + np.exp(-self.slope * np.clip(margin, -500, 500)))

    def paths(self) -> Iterator[tuple[int, list[tuple[int, float, float, float]]]]:
        """Every leaf with what its path asks of each feature on it: (feature, above, at most, share).

        `share` is the part of the training weight that goes on towards the leaf at the feature's splits.
        """
        todo = [(root, {}) for root in reversed(self.roots.tolist())]
        while todo:
            node, asked = todo.pop()
            f = int(self.feature[node])
            if f < 0:
                yield node, [(k, *v) for k, v in asked.items()]
                continue
            above, most, share = asked.get(f, (-np.inf, np.inf, 1.0))
            for child, span in ((self.right[node], (max(above, self.threshold[node]), most)),
                                (self.left[node], (above, min(most, self.threshold[node])))):
                part = share * (self.cover[child] / self.cover[node])
                todo.append((int(child), {**asked, f: (*span, part)}))

    def attributions(self, x: np.ndarray, features: int) -> tuple[np.ndarray, float]:
        """Shapley values of each row's features (they add up to its margin less the second result), and the margin to expect.

        A tree that knows some features goes both ways, by cover, at splits on the others. Among m features of a
        path, a set of k others has the weight of the integral of t**k * (1 - t)**(m - 1 - k) over 0 to 1, so the sum
        over all sets is the integral of a product with one factor a feature: t where the row takes the path, plus
        (1 - t) times the share that does. It is a polynomial, which Gauss's points sum exactly.
        """
        out, expected = np.zeros((len(x), features)), self.base
        missing = np.isnan(x)
        for leaf, asked in self.paths():
            value = self.value[leaf]
            shares = np.array([s for *_, s in asked])
            expected += value * float(np.prod(shares))
            if not asked:
                continue
            on = np.empty((len(x), len(asked)))
            for j, (f, above, most, _) in enumerate(asked):
                # a missing value takes the right way at each split
                on[:, j] = np.where(missing[:, f], most == np.inf, (x[:, f] > above) & (x[:, f] <= most))
            points, weights = np.polynomial.legendre.leggauss(len(asked) // 2 + 1)
            inner = np.zeros_like(on)
            for t, w in zip((points + 1) / 2, weights / 2, strict=True):
                factors = on * t + shares * (1 - t)
                inner += w * factors.prod(axis=1, keepdims=True) / factors
            inner *= (on - shares) * value
            for j, (f, *_) in enumerate(asked):
                out[:, f] += inner[:, j]
        return out, expected

    def table(self, spark: SparkSession) -> DataFrame:
        """One row a node, for storing."""
        tree = np.zeros(len(self.feature), np.int64)
        tree[self.roots] = 1
        columns = {f.name: getattr(self, f.name) for f in fields(self) if isinstance(getattr(self, f.name), np.ndarray) and f.name != "roots"}
        rows = zip(range(len(tree)), (tree == 1).tolist(), *(c.tolist() for c in columns.values()), strict=True)
        ddl = "node long, root boolean, feature long, threshold double, left long, right long, value double, cover double"
        head = spark.createDataFrame(list(rows), ddl)
        return head.withColumns({"base": F.lit(float(self.base)), "slope": F.lit(self.slope).cast("double"), "step": F.lit(self.step)})

    @classmethod
    def of_table(cls, nodes: DataFrame) -> Forest:
        """A stored forest; as large as the model, which is what is read to the driver."""
        rows = nodes.orderBy("node").toPandas()
        arrays = [rows[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value", "cover")]
        slope = rows["slope"].iloc[0]
        return cls(*arrays, np.flatnonzero(rows["root"].to_numpy(bool)), float(rows["base"].iloc[0]),
                   None if np.isnan(slope) else float(slope), bool(rows["step"].iloc[0]))


def forest_of(model: PipelineModel | TreeModel) -> Forest:
    """The trees of a fitted model. Those of Spark ML are read from what it writes, a row a node, and the files removed."""
    if isinstance(model, TreeModel):
        return model.forest
    stage = model.stages[-1]
    if not isinstance(stage, (GBTClassificationModel, RandomForestClassificationModel)):
        raise ValueError(f"no trees in a {type(stage).__name__}")
    spark = SparkSession.active()
    path = fresh_folder(spark, "trees")
    stage.write().save(path)
    stats = F.col("nodeData.impurityStats")
    boosted = isinstance(stage, GBTClassificationModel)
    weights = list(stage.treeWeights)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.coalesce(F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
        (F.col("nodeData.prediction") if boosted else F.try_divide(stats[1], stats[0] + stats[1])).alias("value"),
        (stats[0] if boosted else stats[0] + stats[1]).alias("cover")).orderBy("treeID", "id").toPandas()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
    tree = rows["treeID"].to_numpy(np.int64)
    first = np.searchsorted(tree, np.arange(len(weights)))  # nodes of a tree are numbered from 0
    shift = first[tree]
    share = np.array(weights if boosted else [1 / len(weights)] * len(weights))
    return Forest(rows["feature"].to_numpy(np.int64), rows["threshold"].to_numpy(np.float64),
                  rows["left"].to_numpy(np.int64) + shift, rows["right"].to_numpy(np.int64) + shift,
                  rows["value"].to_numpy(np.float64) * share[tree], rows["cover"].to_numpy(np.float64), first, 0.0, 2.0 if boosted else None)


@dataclass
class TreeModel:
    """A forest that scores rows by their features, stored as a table of nodes."""

    forest: Forest
    features: list[str]

    def score(self, rows: DataFrame) -> DataFrame:
        """`rows` with the probability as `p`. Only the features travel to Python, in Arrow batches."""
        send_package(rows.sparkSession)
        held, features = rows.sparkSession.sparkContext.broadcast(self.forest), self.features

        @F.pandas_udf("double")
        def p(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            return pd.Series(held.value.probabilities(x))

        return rows.withColumn("p", p(*(F.col(f).cast("double") for f in features)))

    def save(self, spark: SparkSession, path: str) -> None:
        """Never written over: a folder that is there is refused."""
        self.forest.table(spark).withColumn("features", F.array(*map(F.lit, self.features))).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        nodes = spark.read.parquet(path)
        return cls(Forest.of_table(nodes), list(nodes.select("features").first()[0]))


def matrix(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """The features of a batch in double precision; nulls are missing values."""
    return np.column_stack([batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features]) if features else np.zeros((batch.num_rows, 0))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def score_all(models: dict[str, PipelineModel | TreeModel], rows: DataFrame, features: list[str] = FEATURES,
              keep: list[str] = ["row_id", "target"]) -> DataFrame:
    """`keep`, run_id and p: every row scored by every model, in one pass over the rows.

    All forests go to the tasks once; a batch of rows is turned into a matrix once and goes through all of them. Equal
    to scoring with one model after the other. Null features count as missing. No models or no rows give no rows.
    """
    spark = rows.sparkSession
    send_package(spark)
    forests = {name: (forest_of(m), m.features if isinstance(m, TreeModel) else features) for name, m in models.items()}
    held = spark.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            keys = [part.column(c) for c in keep]
            for name, (forest, own) in held.value.items():
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array([name] * part.num_rows, pa.string()), pa.array(forest.probabilities(matrix(part, own)))],
                    names=[*keep, "run_id", "p"])

    ddl = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    needed = sorted({f for _, own in forests.values() for f in own} - set(keep))
    return rows.select(*keep, *needed).mapInArrow(run, f"{ddl}, run_id string, p double")


def tree_attributions(model: PipelineModel | TreeModel, rows: DataFrame, features: list[str] = FEATURES,
                      keep: list[str] = ["row_id"]) -> DataFrame:
    """`keep`, margin, expected and a column for each feature: what it adds to the row's margin over the expected one.

    Exact Shapley values of the trees, with unknown features taken both ways by the training weight. A row's
    attributions add up to margin less expected. The margin is the probability for a random forest and the sum before
    the logistic function for boosted trees. One pass; the trees go to the tasks once. No rows give no rows.
    """
    send_package(rows.sparkSession)
    forest = forest_of(model)
    held = rows.sparkSession.sparkContext.broadcast(forest)
    if any(f in keep or f in ("margin", "expected") for f in features):
        raise ValueError("a feature bears the name of a kept column")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            x = matrix(part, features)
            added, expected = held.value.attributions(x, len(features))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(held.value.margins(x)), pa.array(np.full(len(x), expected)),
                 *(pa.array(added[:, j]) for j in range(len(features)))], names=[*keep, "margin", "expected", *features])

    ddl = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep] + ["margin double", "expected double"]
    return rows.select(*keep, *features).mapInArrow(run, ", ".join(ddl + [f"`{f}` double" for f in features]))


def attributed_importance(model: PipelineModel | TreeModel, rows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Features ranked by the mean size of what they add to the rows' margins."""
    return ranked_importance(mean_magnitude(tree_attributions(model, rows, features, []), features))

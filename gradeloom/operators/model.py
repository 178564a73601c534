"""Fit, cross-validate, search, score and keep Spark ML classifiers."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from gradeloom.operators import parzen
from gradeloom.operators.boost import BINS, Binned, fit_binned, fit_leafwise, into_bins
from gradeloom.operators.evaluate import (
    METRICS, auc, best_cutoff, confusion, evaluation, hard_auc, quality, ranked_importance,
)
from gradeloom.operators.ranks import hash_rank
from gradeloom.operators.sample import FOLDS, SPLIT_SEED, balance, folds
from gradeloom.operators.trees import TreeModel
from gradeloom.schema import FEATURES
from gradeloom.session import materialize

FOREST, BOOSTED_FINE, BOOSTED_COARSE = "random_forest", "boosted_fine", "boosted_coarse"
ALGORITHMS = [FOREST, BOOSTED_FINE, BOOSTED_COARSE]

# Class weights, cutoff and limits of the search.
CLASS_WEIGHTS = {1: 2.0, 0: 1.0}
CUTOFF = 0.5
MAX_EVALS = 50
TIMEOUT_MINUTES = 60
LOSS_LIMIT = -0.997
LEAST_SCORE = 0.9
SPARK_MAX_DEPTH = 30

# Draws of a search that don't wait for each other's losses and are tried at the same time.
DRAWS_AT_ONCE = 4

# Ranges the search draws from. Boosted draws name their leaves, which asks for leaf-wise trees.
SPACE = {
    FOREST: {
        "trees": ("int", 15, 125), "depth": ("int", 5, 90), "leaf_rows": ("int", 5, 150),
        "columns": ("choice", ["sqrt", "all"]), "impurity": ("choice", ["gini", "entropy"]),
    },
    BOOSTED_FINE: {
        "trees": ("int", 15, 125), "depth": ("int", 5, 90), "leaf_rows": ("int", 5, 150), "leaves": ("int", 5, 90),
        "rate": ("log", 0.001, 0.3), "columns": ("real", 0.6, 1.0), "drop": ("choice", [0.0, 0.1]),
    },
    BOOSTED_COARSE: {
        "trees": ("int", 15, 100), "depth": ("int", 5, 80), "leaves": ("int", 5, 80),
        "rate": ("log", 0.005, 0.4), "columns": ("real", 0.6, 1.0), "l1": ("log", 0.001, 5.0), "l2": ("log", 0.001, 5.0),
        "drop": ("choice", [0.0, 0.1]), "objective": ("choice", ["logistic", "hinge"]),
    },
}


def classifier(algorithm: str, params: dict, seed: int = SPLIT_SEED):
    """A Spark ML classifier. A depth beyond Spark's limit is refused: a record must name what was fitted."""
    if int(params.get("depth", 5)) > SPARK_MAX_DEPTH:
        raise ValueError(f"depth {params['depth']} is beyond Spark's {SPARK_MAX_DEPTH}")
    shared = {
        "featuresCol": "features", "labelCol": "target", "weightCol": "weight", "seed": seed,
        "maxDepth": int(params.get("depth", 5)),
        "minInstancesPerNode": int(params.get("leaf_rows", 1)),
    }
    if algorithm == FOREST:
        return RandomForestClassifier(
            numTrees=int(params.get("trees", 20)), impurity=params.get("impurity", "gini"),
            featureSubsetStrategy=str(params.get("columns", "sqrt")), **shared,
        )
    if algorithm in (BOOSTED_FINE, BOOSTED_COARSE):
        return GBTClassifier(
            maxIter=int(params.get("trees", 20)), stepSize=float(params.get("rate", 0.1)),
            featureSubsetStrategy=str(params.get("columns", "all")),
            subsamplingRate=float(params.get("rows", 1.0)), **shared,
        )
    raise ValueError(f"unknown algorithm {algorithm!r}, have {ALGORITHMS}")


def fit(train: DataFrame, algorithm: str, params: dict, features: list[str] = FEATURES) -> PipelineModel | TreeModel:
    """Fit on rows of features and target, fails weighted double. Boosted trees with `leaves` are grown leaf by leaf."""
    if leafwise(algorithm, params):
        return fit_leafwise(weighted(train), features, params, SPLIT_SEED)
    stages = [VectorAssembler(inputCols=features, outputCol="features"), classifier(algorithm, params)]
    return Pipeline(stages=stages).fit(weighted(train))


def leafwise(algorithm: str, params: dict) -> bool:
    return algorithm in (BOOSTED_FINE, BOOSTED_COARSE) and "leaves" in params


def weighted(train: DataFrame) -> DataFrame:
    return train.withColumn("weight", F.when(F.col("target") == 1, CLASS_WEIGHTS[1]).otherwise(CLASS_WEIGHTS[0]))


def score(model: PipelineModel | TreeModel, rows: DataFrame) -> DataFrame:
    """`rows` with the probability of a fail as `p`."""
    if isinstance(model, TreeModel):
        return model.score(rows)
    probability = vector_to_array("probability")[1]
    return model.transform(rows).withColumn("p", probability).select(*rows.columns, "p")


def metric_value(scored: DataFrame, metric: str, cutoff: float = CUTOFF, hard: bool = False) -> float:
    """One metric of one scored table; `hard` takes ROC AUC on the classes, not the probabilities."""
    if metric != "roc_auc" or hard:
        row = hard_auc(quality(confusion(scored, cutoff))).first()
    else:
        row = auc(scored).first()
    return float(row["hard_auc" if hard and metric == "roc_auc" else METRICS[metric]] or 0.0)


@dataclass
class Prepared:
    """Balanced training rows, whole and by fold, written once for all fits that follow."""

    features: list[str]
    whole: DataFrame
    folds: list[tuple[DataFrame, DataFrame]]
    bins: dict[tuple, Binned] = field(default_factory=dict)
    lock: threading.Lock = field(default_factory=threading.Lock)

    def fit(self, fold: int | None, algorithm: str, params: dict) -> PipelineModel | TreeModel:
        """A model of what a fold trains on, or of all rows; leaf-wise fits share the rows' bins, which are made once."""
        rows = self.whole if fold is None else self.folds[fold][0]
        if not leafwise(algorithm, params):
            return fit(rows, algorithm, params, self.features)
        key = fold, int(params.get("bins") or BINS)
        with self.lock:
            if key not in self.bins:
                self.bins[key] = into_bins(weighted(rows), self.features, key[1])
        return fit_binned(self.bins[key], params, SPLIT_SEED)


def prepare(
    train: DataFrame,
    features: list[str] = FEATURES,
    k: int = FOLDS,
    method: str = "over",
    balance_first: bool = False,
) -> Prepared:
    """Balance the training rows and cut them into k stratified folds.

    The rows a fold trains on are balanced apart, so that no synthetic row stems from a row it is
    tested against; `balance_first` balances before the folds are cut instead.
    """
    whole = materialize(balance(train, method, features))
    if balance_first:
        # equal rows share an id, which of them comes first in a fold makes no difference
        train, method = whole.withColumn("row_id", F.xxhash64(*features)), "none"
    cut = materialize(folds(train.select("row_id", *features, "target"), k))
    pairs = []
    for fold in range(k):
        rest = balance(cut.where(F.col("fold") != fold), method, features)
        pairs.append((rest if method == "none" else materialize(rest), cut.where(F.col("fold") == fold)))
    return Prepared(features, whole, pairs)


def cross_validate(
    prepared: Prepared, algorithm: str, params: dict, metric: str = "roc_auc", hard: bool = False,
    at_once: int = FOLDS,
) -> list[float]:
    """The score of each fold by a model of the other folds, `at_once` folds at a time."""
    def one(fold: int) -> float:
        model = prepared.fit(fold, algorithm, params)
        return metric_value(score(model, prepared.folds[fold][1]), metric, hard=hard)

    return side_by_side(prepared, one, range(len(prepared.folds)), at_once)


def side_by_side(prepared: Prepared, f: Callable, items, at_once: int) -> list:
    """`f` of each item, so many at a time, in the items' order."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(inheritable_thread_target(prepared.whole.sparkSession)(f), items))


@dataclass
class Built:
    """A fitted model with what its run record needs."""

    run_id: str
    algorithm: str
    params: dict
    model: PipelineModel | TreeModel | None
    cv_scores: list[float]
    cutoff: float = CUTOFF
    version: int = 1
    stage: str = "development"
    test: dict = field(default_factory=dict)
    search_end: str | None = None
    origin: str | None = None  # where a search's draw came from

    @property
    def val_score(self) -> float:
        return sum(self.cv_scores) / len(self.cv_scores)

    @classmethod
    def of(cls, run: Row, model: PipelineModel) -> Built:
        """A stored run with its model."""
        return cls(run["run_id"], run["algorithm"], dict(run["params"] or {}), model, list(run["cv_scores"] or []),
                   run["cutoff"], run["version"], run["stage"], search_end=run["search_end"], origin=run["origin"])

    def record(self) -> dict:
        """The row for the runs table."""
        params = {k: str(v) for k, v in self.params.items()}
        return {
            "run_id": self.run_id, "version": self.version, "algorithm": self.algorithm,
            "stage": self.stage, "params": params, "cutoff": self.cutoff,
            "cv_scores": self.cv_scores, "search_end": self.search_end, "origin": self.origin, **self.test,
        }


def build(prepared: Prepared, run_id: str, algorithm: str, params: dict, metric: str = "roc_auc") -> Built:
    """Cross-validate, then fit on all of the balanced training rows."""
    scores = cross_validate(prepared, algorithm, params, metric)
    return Built(run_id, algorithm, params, prepared.fit(None, algorithm, params), scores)


def search(
    train: DataFrame,
    features: list[str] = FEATURES,
    algorithms: list[str] = ALGORITHMS,
    space: dict = SPACE,
    metric: str = "roc_auc",
    k: int = FOLDS,
    method: str = "over",
    max_evals: int = MAX_EVALS,
    timeout_minutes: float = TIMEOUT_MINUTES,
    loss_limit: float = LOSS_LIMIT,
    least_score: float = LEAST_SCORE,
    depth_limit: int = SPARK_MAX_DEPTH,
    seed: int = SPLIT_SEED,
    search_id: str | None = None,
    on_kept: Callable[[Built], None] | None = None,
    warm: tuple[str, dict] | None = None,
    starts: int = parzen.STARTS,
) -> list[Built]:
    """Seeded draws over algorithms and parameters; the builds that reach `least_score`.

    `warm`, algorithm and parameters of a stored run, is tried first. `starts` draws are random, the others follow
    Parzen estimates of where past draws did well; which it was stands in each build's `origin`.

    Stops at the evaluation count, the time limit, or a loss (minus score) at `loss_limit`; which of them it
    was stands in each build's `search_end`. Run ids hold `search_id`, so that no two searches share one.
    Only what is kept is fitted on all rows. `on_kept` gets each build as it is made, say to save its model
    and let go of it. Random draws are tried DRAWS_AT_ONCE at a time; losses are told in the order of drawing, so the
    draws and builds are those of one at a time.
    """
    prepared = prepare(train, features, k, method)
    name = search_id or uuid.uuid4().hex[:12]
    draws = parzen.Search({a: space[a] for a in algorithms}, seed, warm, depth_limit, starts)
    start, kept, number, end = time.monotonic(), [], 0, "evaluations"

    def step(part: tuple[Built, bool]) -> None:
        built, on_all = part
        if on_all:
            built.model = prepared.fit(None, built.algorithm, built.params)
        else:
            built.cv_scores = cross_validate(prepared, built.algorithm, built.params, metric)

    def tried(built: Built) -> Built:
        if least_score <= 0:  # no score is lower, so the fit on all rows needn't wait for it
            side_by_side(prepared, step, [(built, False), (built, True)], 2)
            return built
        step((built, False))
        if built.val_score >= least_score:
            step((built, True))
        return built

    while number < max_evals and end == "evaluations":
        if time.monotonic() - start > 60 * timeout_minutes:
            end = "time"
            break
        batch = []
        for _ in range(min(draws.ahead(), DRAWS_AT_ONCE, max_evals - number)):
            algorithm, params, origin = draws.next()
            batch.append(Built(f"{algorithm}-{name}-{number}", algorithm, params, None, [], origin=origin))
            number += 1
        for built in side_by_side(prepared, tried, batch, len(batch)):
            draws.tell(built.algorithm, built.params, -built.val_score)
            if built.val_score >= least_score:
                kept.append(built)
                if on_kept is not None:
                    on_kept(built)
            if -built.val_score <= loss_limit:
                end = "loss"
                break
    for built in kept:
        built.search_end = end
    return kept


def update(
    built: Built,
    test: DataFrame,
    train: DataFrame | None = None,
    sweep_on: DataFrame | None = None,
    features: list[str] = FEATURES,
    metric: str = "roc_auc",
) -> Built:
    """Fit again (with `train`), choose the cutoff again (with `sweep_on`), then evaluate on `test`."""
    if train is not None:
        built.model = fit(train, built.algorithm, built.params, features)
        built.version += 1
    if sweep_on is not None:
        built.cutoff = best_cutoff(score(built.model, sweep_on)).first()["cutoff"]
    row = evaluation(score(built.model, test), built.cutoff).first().asDict()
    built.test = {m: row[m] for m in ("roc_auc", "f1", "precision", "recall", "accuracy")}
    built.test["test_score"] = row[METRICS[metric]]
    return built


def native_importance(model: PipelineModel, spark: SparkSession, features: list[str] = FEATURES) -> DataFrame:
    """The trees' own feature importances, ranked, of a model of Spark ML; `attributed_importance` takes any trees."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    pairs = spark.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return ranked_importance(pairs)


def permuted_importance(
    model: PipelineModel, test: DataFrame, features: list[str] = FEATURES, seed: int = SPLIT_SEED
) -> DataFrame:
    """Mean change of the probability when a feature takes another row's value, ranked.

    Rows are ranked by digest once; all features' values move on by half the table in one join on the rank.
    Each row then goes through the model once a feature, with that feature's moved value. Works for any model.
    """
    ranked = materialize(hash_rank(score(model, test.select("row_id", *features)), [], "row_id", seed))
    half = (F.col("class_size") / 2).cast("long")
    moved = ranked.select(((F.col("rank") + half) % F.col("class_size") + 1).alias("rank"), F.array(*features).alias("others"))
    pairs = ranked.withColumnRenamed("p", "before").join(moved, "rank").select(
        "before", "others", *features, F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("number"))
    swapped = pairs.select("before", "number", *[
        F.when(F.col("number") == i, F.col("others")[i]).otherwise(F.col(f)).alias(f) for i, f in enumerate(features)])
    after = score(model, swapped)
    gaps = after.groupBy("number").agg(F.round(F.avg(F.abs(F.col("p") - F.col("before"))), 9).alias("importance"))
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("number") + 1)
    return ranked_importance(gaps.select(name.alias("feature"), "importance"))


def save_model(built: Built, path: str) -> None:
    """The fitted pipeline below `path`, by run and version. One that is there already is never overwritten."""
    target = f"{path}/{built.run_id}/version={built.version}"
    if isinstance(built.model, TreeModel):
        built.model.save(SparkSession.active(), target)
    else:
        built.model.write().save(target)


def load_model(path: str, run_id: str, version: int) -> PipelineModel | TreeModel:
    spark, source = SparkSession.active(), f"{path}/{run_id}/version={version}"
    pipeline = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/metadata")
    if pipeline.getFileSystem(spark._jsc.hadoopConfiguration()).exists(pipeline):
        return PipelineModel.load(source)
    return TreeModel.load(spark, source)

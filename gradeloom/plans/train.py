"""Training, updating and scoring from end to end, over written tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from gradeloom.operators.evaluate import predicted
from gradeloom.operators.model import (
    ALGORITHMS, Built, fit, load_model, save_model, score, search, update,
)
from gradeloom.operators.prefix import latest
from gradeloom.operators.report import prediction_folders
from gradeloom.operators.runs import (
    champion, change_runs, hold_best, last_snapshot, last_versions, load_runs, log_runs, new_runs, promoted, query_runs,
    top_per_algorithm,
)
from gradeloom.operators.sample import SPLIT_SEED, TEST_RATIO, balance, split
from gradeloom.plans.process import HOT_LIMIT, feature_table
from gradeloom.schema import EXAM_GROUPS, FEATURES, KEYS
from gradeloom.session import materialize
from gradeloom.sources.activity import read_table, write_predictions, write_table

CANDIDATES = 10  # fixed value: challengers in staging


def write_splits(features: DataFrame, path: str, ratio: float = TEST_RATIO, seed: int = SPLIT_SEED,
                 group_by: str | None = None) -> DataFrame:
    """Cut the feature table into train and test and write it once, by split."""
    write_table(split(features, ratio, seed, group_by=group_by), path, ["split"])
    return read_splits(features.sparkSession, path)


def read_splits(spark, path: str) -> DataFrame:
    return read_table(spark, path)


def part(splits: DataFrame, name: str) -> DataFrame:
    return splits.where(F.col("split") == name)


def swept_cutoff(train: DataFrame, built: Built, method: str, ratio: float = TEST_RATIO, seed: int = SPLIT_SEED) -> float:
    """The best cutoff on a share of the training rows, by a model of the rest."""
    cut = split(train.drop("split"), ratio, seed + 1)
    rest = materialize(balance(part(cut, "train"), method, FEATURES))
    model = fit(rest, built.algorithm, built.params)
    trial = Built(built.run_id, built.algorithm, built.params, model, built.cv_scores)
    held = part(cut, "test")
    return update(trial, held, sweep_on=held).cutoff


def best_stored(spark, runs_path: str, algorithms: list[str]) -> tuple[str, dict] | None:
    """Algorithm and parameters of the stored run with the best validation score, whatever its stage."""
    if last_snapshot(spark, runs_path) == 0:
        return None
    best = query_runs(load_runs(spark, runs_path).where("val_score is not null"), "val_score", algorithm=list(algorithms)).first()
    return None if best is None else (best["algorithm"], dict(best["params"] or {}))


def train_models(splits: DataFrame, runs_path: str, models_path: str, candidates: int = CANDIDATES,
                 algorithms: list[str] = ALGORITHMS, method: str = "over", warm_start: bool = True, **options) -> list[Built]:
    """Search, save and log every build that reaches the least score, test the best of each algorithm.

    With `warm_start` the search tries the best stored run's parameters first, if there is one.

    Models are saved as they are made and not held. The best get a cutoff swept on a share of the training
    rows and their scores on the test rows. Returns the tested builds.
    """
    spark, train, test = splits.sparkSession, part(splits, "train"), part(splits, "test")

    def save(built: Built) -> None:
        save_model(built, models_path)
        built.model = None

    if warm_start:
        options.setdefault("warm", best_stored(spark, runs_path, algorithms))
    found = search(train, algorithms=algorithms, method=method, on_kept=save, **options)
    if not found:
        return []
    best = top_per_algorithm(new_runs(spark, [b.record() for b in found]), candidates, algorithms)
    names = {r["run_id"] for r in best.select("run_id").collect()}  # at most `candidates` rows
    tested = [b for b in found if b.run_id in names]
    for built in tested:
        built.model = load_model(models_path, built.run_id, built.version)
        built.cutoff = swept_cutoff(train, built, method)
        update(built, test)
    log_runs(new_runs(spark, [b.record() for b in found]), runs_path)
    return tested


def promote(spark, runs_path: str, candidates: int = CANDIDATES, algorithms: list[str] = ALGORITHMS,
            update_champion: bool = True) -> DataFrame:
    """Hold the best of each algorithm, assign stages anew, commit the table without all others."""
    return change_runs(spark, runs_path, lambda old: promoted(old, candidates, algorithms, update_champion))


def update_models(splits: DataFrame, runs_path: str, models_path: str, candidates: int = CANDIDATES,
                  algorithms: list[str] = ALGORITHMS, refit: bool = True, sweep: bool = True,
                  method: str = "over") -> DataFrame:
    """Bring every run that holds a stage up to date with the splits, then promote.

    Each is loaded, fitted again as a new version (`refit`), given a cutoff anew (`sweep`) and tested again. A
    new version takes its run's stage; the version before it loses its own, so the next table has one row a
    run. Runs are at most `candidates` and a champion after retention. Renewed rows and stages are one commit.
    """
    spark, train, test = splits.sparkSession, part(splits, "train"), part(splits, "test")
    table = load_runs(spark, runs_path)
    known = table.select("run_id", "version").collect()  # candidates and what was logged since the last promotion
    rows = hold_best(table, candidates, algorithms).where(F.col("stage").isNotNull()).collect()
    whole = materialize(balance(train, method, FEATURES)) if refit else None
    last, renewed = last_versions(spark, runs_path), []
    for run in rows:
        built = Built.of(run, load_model(models_path, run["run_id"], run["version"]))
        if refit:
            built.version = last[built.run_id]  # update() counts on from here
        if sweep:
            built.cutoff = swept_cutoff(train, built, method)
        update(built, test, train=whole)
        if refit:
            last[built.run_id] = built.version
            save_model(built, models_path)
        built.model = None
        renewed.append(built)
    ours = new_runs(spark, [b.record() for b in renewed])
    seen = spark.createDataFrame([(r["run_id"], r["version"]) for r in known], "run_id string, version int")

    def renew(old: DataFrame) -> DataFrame:
        # what was logged while models were fitted stays in the competition
        later = old.join(seen, ["run_id", "version"], "left_anti")
        return promoted(ours.unionByName(later.select(*ours.columns)), candidates, algorithms)

    return change_runs(spark, runs_path, renew)


def batch_score(model: PipelineModel, activity: DataFrame, groups: dict = EXAM_GROUPS,
                hot_limit: int | None = HOT_LIMIT) -> DataFrame:
    """Clean, build features, take each learner's latest row of a course, add the probability."""
    newest = latest(feature_table(activity, groups, hot_limit))
    return score(model, newest).select(*KEYS, "step", "p")


def score_with_champion(activity: DataFrame, runs_path: str, models_path: str, out_path: str | None = None,
                        groups: dict = EXAM_GROUPS, hot_limit: int | None = HOT_LIMIT,
                        scoring_id: str | None = None) -> DataFrame:
    """Probabilities and classes by the stored champion and its own cutoff, with the time of scoring.

    With `out_path` they are put into the prediction sink under `scoring_id`, in place of what the same scoring put
    there before: by default the scoring of a course up to a step by a version of a run.
    """
    spark = activity.sparkSession
    run = champion(load_runs(spark, runs_path)).first()
    if run is None:
        raise ValueError(f"{runs_path} has no champion")
    model = load_model(models_path, run["run_id"], run["version"])
    scored = batch_score(model, activity, groups, hot_limit).select(
        *KEYS, "p", predicted("p", run["cutoff"]).alias("predicted"),
        F.lit(run["run_id"]).alias("run_id"), F.lit(run["version"]).alias("version"),
        F.current_timestamp().alias("scored_at"))
    scored = prediction_folders(scored, activity)
    if out_path is not None:
        if scoring_id is None:
            slice_ = scored.select("course_name", "step").first()  # the same in all rows
            scoring_id = f"{run['run_id']}-v{run['version']}" + (f"-{slice_['course_name']}-{slice_['step']}" if slice_ else "")
        write_predictions(scored, out_path, scoring_id=scoring_id)
    return scored


__all__ = [
    "FEATURES", "batch_score", "promote", "read_splits", "score_with_champion", "train_models", "update_models",
    "write_splits",
]

"""Balance, split, neighbours, evaluation, runs, files."""

import inspect
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF, activity, row, same
from gradeloom.operators import evaluate as E, model as M, runs as U
from gradeloom.operators import nearest as search
from gradeloom.operators.nearest import nearest
from gradeloom.operators.ranks import hash_rank
from gradeloom.operators.sample import FOLDS, balance, folds, split
from gradeloom.operators.smote import smote
from gradeloom.plans.catalog import QUERIES, part_runs, scored
from gradeloom.plans.gradebook import EXAMS, gradebook
from gradeloom.plans.process import clean_log, feature_table
from gradeloom.plans.train import (
    batch_score, promote, score_with_champion, train_models, update_models, write_splits,
)
from gradeloom.schema import EPOCH_COLUMNS, EXPORT_COLUMNS, FEATURES
from gradeloom.session import materialize
from gradeloom.sources.activity import ingest_export, read_activity, read_table, rejected, write_predictions, write_table


@pytest.fixture(scope="module")
def features(spark):
    return materialize(feature_table(gradebook(spark, SF), EXAMS))


def test_test_rows_keep_the_class_shares(features):
    cut = split(features).groupBy("split").agg(F.avg("target").alias("share"), F.count("*").alias("n")).toPandas()
    shares = cut.set_index("split")["share"]
    whole = features.agg(F.avg("target")).first()[0]
    # one row of the test set is more than 0.001 here
    assert abs(shares["test"] - whole) <= max(0.001, 1 / cut["n"].min())
    assert cut["n"].sum() == features.count()


@pytest.mark.parametrize("method", ["smote", "over", "under"])
def test_balanced_classes_are_equal(features, method):
    train = split(features).where("split = 'train'")
    assert abs(balance(train, method, FEATURES).agg(F.avg("target")).first()[0] - 0.5) <= 0.001


def test_unknown_balance_method(features):
    with pytest.raises(ValueError):
        balance(features, "other", FEATURES)


def test_learners_stay_on_one_side(features):
    sides = split(features, group_by="learner_id").groupBy("learner_id").agg(F.countDistinct("split").alias("n"))
    assert sides.where("n > 1").isEmpty()


def test_folds_hold_each_class_evenly(features):
    counts = folds(features).groupBy("target", "fold").count().toPandas()
    spread = counts.groupby("target")["count"].agg(lambda c: c.max() - c.min())
    assert (spread <= 1).all() and counts["fold"].nunique() == 4


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_rank_does_not_depend_on_the_pieces(features, digits):
    one = hash_rank(features.select("row_id", "target"), ["target"], "row_id", 3, 0).toPandas()
    other = hash_rank(features.select("row_id", "target"), ["target"], "row_id", 3, digits).toPandas()
    same(one, other, 0)


@pytest.mark.parametrize("dims,values,block_rows", [(2, 40, 50), (4, 30, 100), (3, 6, 16)])
def test_neighbours_equal_brute_force(spark, dims, values, block_rows):
    points = np.random.default_rng(dims).integers(0, values, (900, dims)).astype(float)
    points = np.unique(points, axis=0)
    frame = spark.createDataFrame(list(enumerate(points.tolist())), "vid long, v array<double>")
    gaps = ((points[:, None] - points[None]) ** 2).sum(-1)
    np.fill_diagonal(gaps, np.inf)
    ids = np.argsort(gaps, axis=1, kind="stable")[:, :5]
    expected = pd.DataFrame({
        "vid": np.repeat(np.arange(len(points)), 5), "nid": ids.ravel(),
        "gap": np.take_along_axis(gaps, ids, 1).ravel(),
    })
    same(nearest(frame, 5, block_rows).toPandas(), expected, 0)


def test_smote_among_copies(spark):
    """A third of the class is one vector; block size makes no difference."""
    rows = [(i, float(i % 40 if i % 3 else 7), float(i % 11 if i % 3 else 2), 1 if i < 200 else 0) for i in range(700)]
    frame = spark.createDataFrame(rows, "row_id long, a double, b double, target int")
    whole, cut = (smote(frame, ["a", "b"], block_rows=n).toPandas() for n in (2048, 12))
    assert len(whole) == 300
    same(whole, cut, 0)


def test_smote_needs_enough_rows(spark):
    rows = [(i, float(i), 1 if i < 3 else 0) for i in range(20)]
    with pytest.raises(ValueError):
        smote(spark.createDataFrame(rows, "row_id long, a double, target int"), ["a"])


def test_auc_equals_spark_evaluator(spark):
    rows = scored(spark, SF)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="target", numBins=0)
    assert E.auc(rows).first()[0] == pytest.approx(evaluator.evaluate(rows.withColumn("target", F.col("target").cast("double"))), abs=1e-9)


def test_auc_does_not_depend_on_blocks(spark):
    rows = scored(spark, SF)
    assert E.auc(rows, blocks=1).first()[0] == pytest.approx(E.auc(rows, blocks=13).first()[0], abs=1e-12)


def test_one_class_only(spark):
    rows = spark.createDataFrame([(1, 1, 0.4), (2, 1, 0.6)], "row_id long, target int, p double")
    found = E.evaluation(rows).first()
    assert found.roc_auc is None and found.recall == 0.5 and found.precision == 1.0


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        E.with_main_score(E.quality(E.confusion(scored(spark, SF))), "other")


def test_champion_stays_unless_strictly_beaten(spark):
    rows = [
        {"run_id": "old", "stage": "production", "test_score": 0.8, "cv_scores": [0.5]},
        {"run_id": "tie", "stage": "development", "test_score": 0.8, "cv_scores": [0.9]},
        {"run_id": "low", "stage": "staging", "test_score": 0.9, "cv_scores": [0.1]},
    ]
    staged = U.assign_stages(U.new_runs(spark, rows), 1)
    assert {r.run_id: r.stage for r in staged.collect()} == {"old": "production", "tie": "staging", "low": "development"}
    staged = U.assign_stages(U.new_runs(spark, rows), 2)
    assert {r.run_id: r.stage for r in staged.collect()} == {"old": "staging", "tie": "staging", "low": "production"}
    staged = U.assign_stages(U.new_runs(spark, rows), 2, update_champion=False)
    assert {r.run_id: r.stage for r in staged.collect()} == {"old": "production", "tie": "staging", "low": "staging"}


def test_first_champion(spark):
    rows = [{"run_id": n, "stage": "development", "test_score": s, "cv_scores": [s]} for n, s in (("a", 0.7), ("b", 0.6))]
    staged = U.assign_stages(U.new_runs(spark, rows), 2, update_champion=False)
    assert {r.run_id: r.stage for r in staged.collect()} == {"a": "production", "b": "staging"}


def test_runs_are_logged_in_versions_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = [{"run_id": "a", "algorithm": "random_forest", "params": {"trees": "5"}, "cv_scores": [0.5, 0.7]}]
    U.log_runs(U.new_runs(spark, rows), path)
    U.log_runs(U.new_runs(spark, rows), path)
    with pytest.raises(ValueError):
        U.log_runs(U.new_runs(spark, [{**rows[0], "version": 2}]), path)
    assert U.last_versions(spark, path) == {"a": 2}
    assert sorted(r.version for r in U.load_runs(spark, path).collect()) == [1, 2]
    assert U.load_runs(spark, path).first().val_score == pytest.approx(0.6)
    U.save_runs(U.current(U.load_runs(spark, path)), path)
    kept = U.load_runs(spark, path).collect()
    assert U.last_snapshot(spark, path) == 3 and [(r.version, r.params) for r in kept] == [(2, {"trees": "5"})]


def test_train_promote_and_score(spark, tmp_path, features):
    splits = write_splits(features, str(tmp_path / "splits"))
    space = {M.FOREST: {"trees": ("int", 5, 8), "depth": ("int", 3, 4)}}
    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    kept = train_models(splits, runs, models, 2, [M.FOREST], space=space, method="under", k=2, max_evals=2, least_score=0.5)
    assert kept
    table = promote(spark, runs, 2, [M.FOREST])
    crowned = table.where("stage = 'production'").collect()
    assert len(crowned) == 1
    best = next(b for b in kept if b.run_id == crowned[0].run_id)
    loaded = M.load_model(models, best.run_id, best.version)
    same(batch_score(best.model, gradebook(spark, SF), EXAMS).toPandas(),
         batch_score(loaded, gradebook(spark, SF), EXAMS).toPandas(), 0)


def test_worse_second_search_leaves_the_champion(spark, tmp_path, features):
    splits = write_splits(features, str(tmp_path / "splits"))
    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    options = {"method": "under", "k": 2, "max_evals": 1, "least_score": 0.0}
    good = {M.FOREST: {"trees": ("int", 12, 12), "depth": ("int", 6, 6)}}
    poor = {M.FOREST: {"trees": ("int", 1, 1), "depth": ("int", 1, 1), "leaf_rows": ("int", 150, 150)}}
    (first,) = train_models(splits, runs, models, 2, [M.FOREST], space=good, **options)
    promote(spark, runs, 2, [M.FOREST])
    (second,) = train_models(splits, runs, models, 2, [M.FOREST], space=poor, **options)
    assert second.run_id != first.run_id and second.test["test_score"] < first.test["test_score"]
    table = {r.run_id: r.stage for r in promote(spark, runs, 2, [M.FOREST]).collect()}
    assert table == {first.run_id: "production", second.run_id: "staging"}
    M.load_model(models, first.run_id, first.version)
    # brought up to date: new versions, one row a run, old files still there
    table = {r.run_id: r for r in update_models(splits, runs, models, 2, [M.FOREST], method="under").collect()}
    assert {r.version for r in table.values()} == {2} and len(table) == 2
    assert sum(r.stage == "production" for r in table.values()) == 1
    M.load_model(models, first.run_id, 1)
    out = str(tmp_path / "predictions")
    for _ in range(2):
        rows = score_with_champion(gradebook(spark, SF), runs, models, out, EXAMS)
    champion = next(r for r in table.values() if r.stage == "production")
    got = rows.collect()
    assert {(r.run_id, r.version) for r in got} == {(champion.run_id, 2)}
    assert all(r.predicted == (r.p > champion.cutoff) for r in got)
    stored = spark.read.json(out)
    # the same scoring again takes the place of the first
    assert stored.count() == len(got) and stored.select("scored_at").distinct().count() == 1
    score_with_champion(gradebook(spark, SF), runs, models, out, EXAMS, scoring_id="by hand")
    assert spark.read.json(out).groupBy("scoring_id").count().count() == 2


def test_retention_drops(spark):
    rows = [{"run_id": f"r{i}", "version": v, "algorithm": a, "stage": s, "cv_scores": [x], "test_score": t} for i, v, a, s, x, t in [
        (0, 1, "f", "production", 0.1, 0.9), (0, 2, "f", "development", 0.9, 0.5), (1, 1, "f", "staging", 0.8, 0.6),
        (2, 1, "f", "development", 0.7, 0.99), (3, 1, "g", "development", 0.2, 0.3), (4, 1, "g", None, 0.95, 0.99)]]
    left = U.promoted(U.new_runs(spark, rows), 4, ["f", "g"])
    assert {(r.run_id, r.version): r.stage for r in left.collect()} == {
        ("r0", 1): "production", ("r0", 2): "staging", ("r1", 1): "staging", ("r3", 1): "staging"}


def test_folds_balanced_apart_or_before(spark, features):
    for first in (False, True):
        prepared = M.prepare(features, k=2, method="over", balance_first=first)
        scores = M.cross_validate(prepared, M.FOREST, {"trees": 3, "depth": 3}, hard=first)
        assert len(scores) == 2 and all(0.3 < s <= 1 for s in scores)


def test_importance_of_permuted_columns(spark, features):
    model = M.fit(features, M.FOREST, {"trees": 5, "depth": 4}, ["exam_grade_mean", "tasks_sum", "step"])
    ranked = M.permuted_importance(model, features, ["exam_grade_mean", "tasks_sum", "step"]).collect()
    assert len(ranked) == 3 and ranked[-1].running_share == pytest.approx(1.0)


def test_depth_beyond_spark_is_refused_and_never_drawn():
    with pytest.raises(ValueError):
        M.classifier(M.FOREST, {"depth": 90})
    drawn = [M.parzen.at_random(random.Random(i), M.SPACE[M.FOREST], M.SPARK_MAX_DEPTH)["depth"] for i in range(300)]
    assert max(drawn) <= 30 and sum(d == 30 for d in drawn) < 40


def test_csv_log_reads_like_the_table(spark, tmp_path):
    log = gradebook(spark, SF)
    log.write.csv(str(tmp_path / "csv"), sep=";", header=True)
    read = read_activity(spark, str(tmp_path / "csv"), format="csv")
    same(read.toPandas(), log.toPandas(), 0)


def test_csv_epochs_with_fractions_are_cut(spark, tmp_path):
    log = activity(spark, [row(1, exam_name="PART 1", exam_table_at=5)])
    text = log.withColumns({c: F.col(c) + F.lit(0.9) for c in EPOCH_COLUMNS})
    text.write.csv(str(tmp_path / "csv"), sep=";", header=True)
    assert read_activity(spark, str(tmp_path / "csv"), format="csv").first().exam_table_at == 5


def test_words_for_missing_values_and_bad_numbers(spark, tmp_path):
    header = ";".join(EXPORT_COLUMNS)
    cells = {c: "" for c in EXPORT_COLUMNS} | {"user_uuid": "L1", "course_uuid": "C1"}
    lines = [cells | {"nombre_examen": "NA", "nota_parcial": "nan", "particion": "3"},
             cells | {"nombre_examen": '"PART\n1"', "nota_parcial": "seven", "particion": "N/A"},
             cells | {"nombre_examen": "PART 2", "nota_parcial": "7.5", "particion": "4", "s_created_at": "9.0", "periodo": "3-2024"}]
    (tmp_path / "export.csv").write_text("\n".join([header, *(";".join(x.values()) for x in lines)]) + "\n")
    rows = ingest_export(spark, str(tmp_path / "export.csv"), str(tmp_path / "log"), multiline=True).orderBy("row_id").collect()
    assert [(r.exam_name, r.exam_grade, r.step) for r in rows] == [(None, None, 3.0), ("PART\n1", None, None), ("PART 2", 7.5, 4.0)]
    assert rows[2].sub_created_at == 9 and rows[2].term == "3-2024"
    raw = spark.createDataFrame([("x", "7"), ("5.5", "NA")], "exam_grade string, final_grade string")
    assert {r.column: r["values"] for r in rejected(raw).collect()} == {"exam_grade": 1, "final_grade": 0}


def test_only_wanted_vectors_are_answered(spark):
    frame = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(300)], "vid long, v array<double>")
    wanted = frame.where("vid % 50 = 3").select("vid")
    for rows in (30, 2048):
        part = nearest(frame, 4, rows, wanted).toPandas()
        same(part, nearest(frame, 4, rows).where("vid % 50 = 3").toPandas(), 0)


def test_export_keeps_the_order_of_its_lines(spark, tmp_path):
    log = gradebook(spark, SF)
    names = {ours: theirs for theirs, ours in EXPORT_COLUMNS.items()}
    frame = log.drop("row_id").withColumnsRenamed(names).toPandas()
    for c in ("ass_due_at", "ass_unlock_at"):
        frame[c] = frame[c].astype(float)  # exports carry epochs like 1704067207.0
    frame.to_csv(tmp_path / "export.csv", sep=";", index=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20000)
    read = ingest_export(spark, str(tmp_path / "export.csv"), str(tmp_path / "activity"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = log.toPandas()
    expected["row_id"] = range(len(expected))
    same(read.toPandas(), expected, 0)


def test_area_does_not_depend_on_blocks(spark):
    points = E.roc_points(scored(spark, SF))
    areas = [E.area_under(points, blocks=n).first()[0] for n in (1, 7)]
    assert areas[0] == pytest.approx(areas[1], abs=1e-12)
    assert areas[0] == pytest.approx(E.auc(scored(spark, SF)).first()[0], abs=1e-12)


def test_clean_log_and_features_round_trip(spark, tmp_path, features):
    clean = clean_log(gradebook(spark, SF))
    write_table(clean, str(tmp_path / "clean"))
    write_table(features, str(tmp_path / "features"), ["target"])
    assert read_table(spark, str(tmp_path / "clean")).count() == clean.count()
    same(read_table(spark, str(tmp_path / "features")).toPandas(), features.toPandas(), 0)


def test_prediction_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("L1", "C1", "all", 3.0, 0.25)], "learner_id string, course_id string, course_name string, step double, p double")
    write_predictions(rows, str(tmp_path / "json"))
    write_predictions(rows, str(tmp_path / "csv"), "csv")
    back = spark.read.json(str(tmp_path / "json")).first()
    assert (back.course_name, back.step, back.p) == ("all", 3.0, 0.25)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first().p == "0.25"


def test_filters_reach_the_scan(spark, tmp_path):
    write_table(gradebook(spark, SF), str(tmp_path / "log"))
    found = read_activity(spark, str(tmp_path / "log"), course_name="Course 1", max_step=5.0).select("row_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(course_name,Course 1)" in plan and "exam_grade" not in plan
    for filters, pushed in ((dict(max_step=5.0, keep_null_step=True), "Or(LessThanOrEqual(step,5.0),IsNull(step))"),
                            (dict(term="03-2024"), "StringEndsWith(term,3-2024)")):
        found = read_activity(spark, str(tmp_path / "log"), **filters).select("row_id")
        assert pushed in found._jdf.queryExecution().executedPlan().toString()


def test_neighbours_in_many_dimensions_make_few_rows(spark, monkeypatch):
    """Vectors that differ most in a few of 44 dimensions visit few parts, and each visit is one row."""
    rng = np.random.default_rng(5)
    points = np.round(rng.lognormal(0, 2, (1500, 44)) * np.repeat([1000, 1], [4, 40]))
    frame = spark.createDataFrame(list(enumerate(points.tolist())), "vid long, v array<double>")
    seen, kept = [], search.visits
    monkeypatch.setattr(search, "visits", lambda *a: seen.append(kept(*a).count()) or kept(*a))
    got = nearest(frame, 3, 100).toPandas()
    gaps = search.distances(points, points)
    np.fill_diagonal(gaps, np.inf)
    ids = np.argsort(gaps, axis=1, kind="stable")[:, :3]
    expected = pd.DataFrame({"vid": np.repeat(np.arange(1500), 3), "nid": ids.ravel(), "gap": np.take_along_axis(gaps, ids, 1).ravel()})
    same(got, expected, 0)
    assert seen and max(seen) < 1500 * 15 / 2  # far from all of 15 parts


def test_searched_runs_makes_every_evaluation_of_the_whole_ranges(spark, monkeypatch):
    asked = []
    bound = lambda *a, **b: inspect.signature(kept).bind(*a, **b)
    kept = M.search

    def seen(*a, **b):
        call = bound(*a, **b)
        call.apply_defaults()
        asked.append(call.arguments)
        return [M.Built("trial-0", M.FOREST, {}, None, [0.5])]

    monkeypatch.setattr(M, "search", seen)
    QUERIES["searched_runs"](spark, SF).collect()
    (asked,) = asked
    assert asked["space"] is M.SPACE and asked["algorithms"] == M.ALGORITHMS and asked["features"] == FEATURES
    assert (asked["max_evals"], asked["k"], asked["method"], asked["least_score"]) == (M.MAX_EVALS, FOLDS, "over", 0.0)
    assert asked["timeout_minutes"] == math.inf and asked["loss_limit"] == -math.inf


@pytest.mark.parametrize("least, limit, ends", [(0.0, -2.0, ("evaluations", 7)), (0.5, -0.01, ("loss", 1))])
def test_draws_tried_together_are_those_of_one_at_a_time(spark, features, monkeypatch, least, limit, ends):
    """The first is a stored one, five are random, the last follows the others' losses."""
    scores = lambda params: [round(0.5 + (zlib.crc32(str(params).encode()) % 400) / 1000, 3)] * 2
    monkeypatch.setattr(M, "cross_validate", lambda prepared, algorithm, params, metric: scores(params))
    monkeypatch.setattr(M.Prepared, "fit", lambda self, fold, algorithm, params: (fold, algorithm))
    monkeypatch.setattr(M, "prepare", lambda train, *_: M.Prepared([], train, []))
    found = []
    for at_once in (1, 4):
        monkeypatch.setattr(M, "DRAWS_AT_ONCE", at_once)
        made = []
        runs = M.search(features, max_evals=7, starts=6, least_score=least, loss_limit=limit, search_id="s",
                        warm=(M.FOREST, {"trees": "20"}), on_kept=lambda b: made.append(b.run_id))
        assert made == [b.run_id for b in runs] and {b.search_end for b in runs} == {ends[0]} and len(runs) == ends[1]
        found.append([(b.run_id, b.params, b.origin, b.val_score) for b in runs])
    assert found[0] == found[1]
    assert ends[1] == 1 or [o for _, _, o, _ in found[0]] == ["stored", *["random"] * 5, "model"]

"""Cleaning and features on made logs: single cases by hand, mixed rows against row-wise SQL."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import activity, row, same
from gradeloom.checks import sql
from gradeloom.operators.align import align
from gradeloom.operators.prefix import latest
from gradeloom.operators.repair import malformed_terms, repair
from gradeloom.plans.catalog import CLEAN_COLUMNS
from gradeloom.plans.gradebook import EXAMS
from gradeloom.plans.process import clean_log, feature_table
from gradeloom.schema import ACTIVITY, EPOCH_COLUMNS, FEATURES, KEYS
from gradeloom.sources.activity import conform, filter_activity


def mixed_rows(seed, n=400):
    """Rows of every kind, also exam, creation and submission on one row, and null keys."""
    rng = random.Random(seed)
    exams = [n for names in EXAMS.values() for n in names] + ["OTHER"]
    out = []
    for i in range(n):
        r = {"row_id": i, "course_name": rng.choice(["x", "y", None]), "learner_no": rng.choice(["1", None]),
             "term": rng.choice(["3-2024", "11-2024", "2024", None])}
        r["learner_id"] = rng.choice(["L1", "L2", "L3", None])
        r["course_id"] = rng.choice(["C1", "C2"])
        r["step"] = rng.choice([None, 0.0, 1.0, 2.0, 3.0, 4.0])
        r["final_grade"] = rng.choice([None, 3.0, 4.0, 9.0])
        if rng.random() < 0.4:
            r["exam_name"] = rng.choice(exams)
            r["exam_grade"] = rng.choice([None, 2.0, 4.5, 8.0])
            r["exam_table_at"] = rng.choice([None, 0, 1700000000 + i])
        if rng.random() < 0.4:
            r["task_name"] = f"A{rng.randrange(8)}"
            r["task_id"] = rng.choice([None, f"T{i}"])
            for c in EPOCH_COLUMNS[:4]:
                r[c] = rng.choice([None, 0, 1700000000 + rng.randrange(10**6)])
            r["task_points"] = rng.choice([None, 5.0, 10.0])
        if rng.random() < 0.4:
            r["sub_task_name"] = f"A{rng.randrange(8)}"
            r["sub_score"] = rng.choice([None, 0.0, 3.0, 7.5])
            for c in EPOCH_COLUMNS[4:7]:
                r[c] = rng.choice([None, 0, 1700000000 + rng.randrange(10**6)])
        out.append(r)
    rng.shuffle(out)
    return out


def by_sql(rows, ctes, select):
    con = duckdb.connect()
    frame = pd.DataFrame([{f.name: r.get(f.name) for f in ACTIVITY} for r in rows])
    types = {"string": "varchar", "double": "double", "bigint": "bigint"}
    columns = ", ".join(
        f"cast({f.name} as {types[f.dataType.simpleString()]}) as {f.name}" for f in ACTIVITY
    )
    con.register("frame", frame)
    con.execute(f"create table activity as select {columns} from frame")
    return con.execute(sql.with_ctes(ctes[1:], select)).df()


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("hot_limit", [None, 20])
def test_mixed_rows_clean_like_pairs(spark, seed, hot_limit):
    rows = mixed_rows(seed)
    found = clean_log(activity(spark, rows).repartition(3), hot_limit).select(
        *[F.unix_seconds(c).alias(c) if c in EPOCH_COLUMNS else c for c in CLEAN_COLUMNS]
    )
    same(found.toPandas(), by_sql(rows, sql.CLEANED, f"select {', '.join(CLEAN_COLUMNS)} from clean"))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot_limit", [None, 20])
def test_mixed_rows_running_features(spark, seed, hot_limit):
    rows = mixed_rows(seed)
    columns = ["row_id", *KEYS, "target", *FEATURES]
    found = feature_table(activity(spark, rows).repartition(3), EXAMS, hot_limit).select(columns).toPandas()
    same(found, by_sql(rows, sql.FEATURED, f"select {', '.join(columns)} from features"), 1e-7)


def test_aligned_pairs_are_counted_not_spelled_out(spark):
    rows = [row(i, task_name="A", task_points=float(i)) for i in range(4)]
    rows += [row(10 + i, sub_task_name="A", sub_score=6.0) for i in range(3)]
    aligned = align(repair(activity(spark, rows))).where("tie_rank = 1").collect()
    assert [(r.weight, r.points_sum, r.points_n) for r in aligned] == [(4, 6.0, 4)] * 3


def test_creation_without_submission_scores_zero(spark):
    clean = clean_log(activity(spark, [row(1, task_name="A", sub_score=9.0)]), None).first()
    assert (clean.sub_task_name, clean.sub_score) == ("A", 0.0)


def test_submission_without_creation_stays(spark):
    clean = clean_log(activity(spark, [row(1, sub_task_name="A", sub_score=9.0)]), None).first()
    assert (clean.task_name, clean.sub_score) == (None, 9.0)


def test_submitted_creation_stays_blank(spark):
    log = [row(1, task_name="A", task_id="T"), row(2, sub_task_name="A", sub_score=5.0)]
    clean = {r.row_id: r for r in clean_log(activity(spark, log), None).collect()}
    assert clean[1].task_name is None and clean[1].sub_task_name is None
    assert clean[2].task_id == "T"


def test_exam_over_two_steps_takes_the_mean_step(spark):
    log = [row(1, step=1.0, exam_name="PART 1", exam_grade=4.0), row(2, step=2.0, exam_name="PART 1", exam_grade=8.0)]
    clean = clean_log(activity(spark, log), None).collect()
    assert [(r.step, r.exam_grade, r.tie_rank) for r in clean] == [(1.5, 6.0, 2)]


def test_null_keys_leave_and_epoch_zero_is_null(spark):
    log = [row(1, learner=None), row(2, exam_name="PART 1", exam_table_at=0)]
    clean = clean_log(activity(spark, log), None).collect()
    assert [(r.row_id, r.exam_table_at, r.exam_grade) for r in clean] == [(2, None, 0.0)]


def test_nan_is_null_at_load(spark):
    loaded = conform(activity(spark, [row(1, exam_name="PART 1", exam_grade=float("nan"))]))
    assert loaded.first().exam_grade is None
    assert feature_table(loaded, EXAMS, None).first().exam_grade_mean == 0.0


def test_null_final_grade_is_a_fail(spark):
    log = [row(1, exam_name="PART 1", final_grade=None), row(2, learner="L2", exam_name="PART 1", final_grade=4.0)]
    found = {r.learner_id: r.target for r in feature_table(activity(spark, log), EXAMS, None).collect()}
    assert found == {"L1": 1, "L2": 0}


def test_step_cut_and_null_steps(spark):
    log = activity(spark, [row(1, step=None), row(2, step=3.0), row(3, step=9.0)])
    assert [r.row_id for r in filter_activity(log, max_step=5).collect()] == [2]
    assert [r.row_id for r in filter_activity(log, max_step=5, keep_null_step=True).collect()] == [1, 2]


def test_malformed_terms_are_null_and_counted(spark):
    log = activity(spark, [row(1), {**row(2), "term": "2024"}, {**row(3), "term": None}])
    assert [r.term for r in repair(log).orderBy("row_id").collect()] == ["03-2024", None, None]
    assert malformed_terms(log).first()[0] == 1


def test_one_value_has_no_spread_and_zero_score_no_ratio(spark):
    log = [row(1, exam_name="PART 1", exam_grade=6.0), row(2, sub_task_name="A", sub_score=0.0, step=2.0)]
    last = latest(feature_table(activity(spark, log), EXAMS, None)).first()
    assert (last.exam_grade_std, last.grade_per_score, last.zero_tasks_sum) == (0.0, 0.0, 1.0)


def test_latest_row_is_the_first_of_the_highest_step(spark):
    log = [row(1, exam_name="PART 1", exam_grade=2.0, step=5.0), row(2, sub_task_name="A", sub_score=1.0, step=5.0)]
    last = latest(feature_table(activity(spark, log), EXAMS, None)).first()
    assert (last.row_id, last.tasks_sum) == (1, 0.0)


def test_learner_in_two_courses_keeps_both(spark):
    log = [row(1, exam_name="PART 1"), row(2, course="C2", exam_name="PART 1")]
    assert latest(feature_table(activity(spark, log), EXAMS, None)).count() == 2


def test_empty_log(spark):
    assert feature_table(activity(spark, []), EXAMS).count() == 0


def test_one_exchange_for_ordinary_groups(spark):
    table = feature_table(activity(spark, mixed_rows(4)), EXAMS, None)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    # alignment, two folds, running features
    assert plan.count("Window [") == 4

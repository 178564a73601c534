"""Fold repeated exams and repeated submissions of a learner and course into one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradeloom.schema import EPOCH_COLUMNS, KEYS, TEXT_COLUMNS

MEAN_COLUMNS = ["step", "exam_grade", "final_grade", "sub_score"]

EXAM_RANK = 2
TASK_RANK = 3

# Folded rows stand in name order among rows of one step. The key is unique, so the result does not
# depend on how the input lies.
TIE_NAME = f"case tie_rank when {EXAM_RANK} then exam_name when {TASK_RANK} then sub_task_name else '' end"
ORDER_KEY = ["step", "tie_rank", f"{TIE_NAME} as tie_name", "row_id"]

# Row order that decides which text is the first. After the exams are folded, the folded rows stand
# behind all others by exam name, whatever their step.
LOG_PLACE = "struct(step, tie_rank, row_id)"
FOLDED_PLACE = (
    f"if(tie_rank = {EXAM_RANK}, struct(1 as a, 0.0D as b, 0 as c, exam_name as d, row_id as e),"
    " struct(0 as a, step as b, tie_rank as c, '' as d, row_id as e))"
)


def order_key() -> list:
    return [F.expr(c) for c in ORDER_KEY]


def fold(log: DataFrame, name: str, rank: int, place: str, in_place: bool = False) -> DataFrame:
    """One row per learner, course and `name`; rows without the name pass through as they are.

    Numbers become the mean of their non-null values over the pairs, texts and instants the first
    non-null in the order of `place`. A row without the name is a group of its own (`alone`), so one
    pass does both.

    Aggregates are combined before the shuffle, so a hot name never meets in one task. `in_place` is
    for a log that lies by (learner, course) in groups that fit a task: a window over the sorted rows
    costs less than half of the aggregation's time there.
    """
    ready = log.selectExpr(
        "*",
        f"if({name} is null, row_id, null) as alone",
        f"if({name} is null, 1, weight) as pairs",
        f"{place} as place",
    )
    texts = [c for c in TEXT_COLUMNS + EPOCH_COLUMNS if c != name]
    calls = {"points_sum": "sum(points_sum)", "points_n": "sum(points_n)", "pairs": "sum(pairs)",
             "weight": "max(weight)", "tie_rank": "min(tie_rank)", "row_id": "min(row_id)"}
    for c in MEAN_COLUMNS:
        calls |= {f"{c}_sum": f"sum({c} * pairs)", f"{c}_n": f"sum(if({c} is null, null, pairs))"}
    if in_place:
        part = f"partition by {', '.join(KEYS)}, {name}, alone order by place"
        w = f"({part} rows between unbounded preceding and unbounded following)"
        grouped = ready.selectExpr(
            *KEYS, name, f"row_number() over ({part}) as n",
            *[f"{call} over {w} as {c}" for c, call in calls.items()],
            *[f"first({c}, true) over {w} as {c}" for c in texts],
        ).where("n = 1")
    else:
        grouped = ready.groupBy(*KEYS, name, "alone").agg(
            *[F.expr(f"{call} as {c}") for c, call in calls.items()],
            *[F.expr(f"min_by({c}, if({c} is null, null, place)) as {c}") for c in texts],
        )
    return grouped.selectExpr(
        # rounded, as sums come in any order and `step` is the first thing that orders rows
        "row_id", *KEYS, *[f"round(try_divide({c}_sum, {c}_n), 9) as {c}" for c in MEAN_COLUMNS],
        *TEXT_COLUMNS, *EPOCH_COLUMNS,
        # a named row is one row from here on, whatever it was folded from
        f"if({name} is null, points_sum, try_divide(points_sum, points_n)) as points_sum",
        f"if({name} is null, points_n, least(points_n, 1)) as points_n",
        f"if({name} is null, weight, 1) as weight",
        f"if({name} is not null and pairs > 1, {rank}, tie_rank) as tie_rank",
    )


def fold_exams(log: DataFrame, in_place: bool = False) -> DataFrame:
    return fold(log, "exam_name", EXAM_RANK, LOG_PLACE, in_place)


def collapse(aligned: DataFrame, in_place: bool = False) -> DataFrame:
    """Exams first, then submissions on the result."""
    once = fold(fold_exams(aligned, in_place), "sub_task_name", TASK_RANK, FOLDED_PLACE, in_place)
    return once.selectExpr(
        "row_id", *KEYS, *MEAN_COLUMNS, *TEXT_COLUMNS, *EPOCH_COLUMNS,
        "try_divide(points_sum, points_n) as task_points", "tie_rank",
    )


def repeated(log: DataFrame, name: str) -> DataFrame:
    """Rows that share learner, course and name with another row.

    Groups are counted with a partial aggregate and joined back, where a window would put a hot name
    into one task.
    """
    named = log.where(F.col(name).isNotNull())
    groups = named.groupBy(*KEYS, name).agg(F.count("*").alias("copies")).where("copies > 1")
    return named.join(groups, [*KEYS, name])

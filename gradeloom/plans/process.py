"""From raw activity to the cleaned log and the feature table.

Ordinary groups take the short way: one exchange by (learner, course), after which alignment,
collapse and running features are windows over rows already in place. A group above `hot_limit` rows
would fill a task on that way, so such groups go round it: aggregates combined before each shuffle, a
join that may split its hot key, and running totals in blocks. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gradeloom.operators.align import align, align_in_place
from gradeloom.operators.collapse import collapse, order_key
from gradeloom.operators.prefix import finished, measured, running, running_in_blocks
from gradeloom.operators.repair import repair
from gradeloom.schema import EXAM_GROUPS, KEYS
from gradeloom.session import materialize, tuned

HOT_LIMIT = 1_000_000


def hot_groups(activity: DataFrame, limit: int) -> DataFrame | None:
    """Learner-course groups above `limit` rows, or None. At most rows / limit of them.

    Cleaning never adds rows to a group, so counting two columns of the raw log is enough.
    """
    counts = activity.dropna(subset=KEYS).groupBy(*KEYS).agg(F.count("*").alias("n"))
    hot = materialize(counts.where(F.col("n") > limit).select(*KEYS))
    return None if hot.isEmpty() else hot


def by_size(
    activity: DataFrame,
    ordinary: Callable[[DataFrame], DataFrame],
    hot: Callable[[DataFrame], DataFrame],
    limit: int | None,
) -> DataFrame:
    """Send each group the way its size asks for. `limit=None` states that no group is hot."""
    tuned(activity.sparkSession)
    large = hot_groups(activity, limit) if limit is not None else None
    if large is None:
        return ordinary(activity.repartition(*KEYS))
    few = activity.join(large, KEYS, "left_anti").repartition(*KEYS)
    many = activity.join(large, KEYS, "left_semi")
    return ordinary(few).unionByName(hot(many))


def cleaned_in_place(part: DataFrame) -> DataFrame:
    return collapse(align_in_place(repair(part)), in_place=True)


def cleaned_any_size(part: DataFrame) -> DataFrame:
    return collapse(align(repair(part)))


def clean_log(activity: DataFrame, hot_limit: int | None = HOT_LIMIT) -> DataFrame:
    """The cleaned log: one row per exam and submission, unordered."""
    return by_size(activity, cleaned_in_place, cleaned_any_size, hot_limit)


def feature_table(
    activity: DataFrame,
    groups: dict = EXAM_GROUPS,
    hot_limit: int | None = HOT_LIMIT,
    keep_null_hours: bool = False,
) -> DataFrame:
    """Running features for every row of the cleaned log from the first exam or task on."""
    return by_size(
        activity,
        lambda part: finished(running(measured(cleaned_in_place(part), groups, keep_null_hours))),
        lambda part: finished(running_in_blocks(measured(cleaned_any_size(part), groups, keep_null_hours))),
        hot_limit,
    )


def exam_history(activity: DataFrame, hot_limit: int | None = HOT_LIMIT) -> DataFrame:
    """Running exam statistics on the repaired log, before alignment and collapse."""

    def rows(part: DataFrame) -> DataFrame:
        return repair(part).selectExpr(
            *KEYS, "row_id", "step", "0 as tie_rank", "'' as tie_name", "0 as target", "exam_grade",
            "if(exam_grade is null, 0, 1) as graded",
        )

    wanted = ({"graded_sum": "graded"}, ["exam_grade"])
    return by_size(
        activity,
        lambda part: running(rows(part), *wanted),
        lambda part: running_in_blocks(rows(part), *wanted),
        hot_limit,
    )


def sorted_log(clean: DataFrame) -> DataFrame:
    """The cleaned log in learner, course and row order, for people and files."""
    return clean.orderBy(*KEYS, *order_key())

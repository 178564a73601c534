"""Column expressions: repairs, targets, timings, exam groups, percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gradeloom.schema import EXAM_GROUPS


def real(c: str) -> Column:
    """NaN as null: Spark would rank NaN above every grade."""
    return F.when(~F.isnan(c), F.col(c))


def repaired_term(c: str = "term") -> Column:
    """`d-yyyy` as `dd-yyyy`; null unless there are exactly two parts."""
    parts = F.split(F.col(c), "-")
    return F.when(
        F.size(parts) == 2,
        F.concat(F.right(F.concat(F.lit("0"), parts[0]), F.lit(2)), F.lit("-"), parts[1]),
    )


def instant(c: str) -> Column:
    """Epoch seconds as timestamp; missing and 0 are both null."""
    return F.when(F.col(c) != 0, F.timestamp_seconds(F.col(c).cast("long")))


def graded(grade: str, name: str) -> Column:
    """A named exam or task without grade counts 0."""
    return F.when(F.col(name).isNotNull() & F.col(grade).isNull(), 0.0).otherwise(F.col(grade))


def fails(grade: str = "final_grade", pass_mark: float = 4.0) -> Column:
    """1 for a fail; a missing final grade is a fail."""
    return F.when(F.col(grade) >= pass_mark, 0).otherwise(1)


def hours_between(later: str, earlier: str) -> Column:
    return (F.unix_seconds(later) - F.unix_seconds(earlier)) / 3600.0


def task_hours(later: str, earlier: str, keep_null: bool = False) -> Column:
    """Hours between two instants of a row that names a task, else 0 (or null)."""
    hours = F.when(F.col("task_name").isNotNull(), hours_between(later, earlier))
    return hours if keep_null else F.coalesce(hours, F.lit(0.0))


def timings(keep_null: bool = False) -> dict[str, Column]:
    allowed = task_hours("task_due_at", "task_unlock_at", keep_null)
    taken = task_hours("sub_submitted_at", "task_unlock_at", keep_null)
    share = F.when(allowed > 0, taken / allowed)
    return {
        "hours_allowed": allowed,
        "hours_taken": taken,
        "share_taken": share if keep_null else F.coalesce(share, F.lit(0.0)),
        "hours_early": task_hours("task_due_at", "sub_submitted_at", keep_null),
    }


def exam_flags(groups: dict[str, list[str]] = EXAM_GROUPS) -> dict[str, Column]:
    """One 0/1 flag and one split grade for each exam group, and the any-exam flag."""
    out = {}
    for group, names in groups.items():
        inside = F.col("exam_name").isin(names)
        out[f"{group}_flag"] = F.when(inside, 1).otherwise(0)
        out[f"{group}_grade"] = F.when(inside, F.col("exam_grade"))
    out["exam_flag"] = F.when(F.col("exam_name").isNotNull(), 1).otherwise(0)
    return out


def task_flags() -> dict[str, Column]:
    named = F.col("sub_task_name").isNotNull()
    return {
        "task_flag": F.when(named, 1).otherwise(0),
        "zero_task_flag": F.when(named & (F.col("sub_score") <= 0), 1).otherwise(0),
    }


def grade_per_score(grade: str = "exam_grade_mean", score: str = "sub_score_mean") -> Column:
    return F.when(F.col(score) > 0, 100.0 * F.col(grade) / F.col(score)).otherwise(0.0)


def sigmoid(c: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-c))


def percent(p: str) -> Column:
    """Probability as percent with one decimal, halves to even."""
    return F.bround(100.0 * F.col(p), 1)


def verdict(percent_column: str, cutoff: float) -> Column:
    return F.when(F.col(percent_column) >= cutoff * 100.0, "Fail").otherwise("Pass")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 where it is undefined."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

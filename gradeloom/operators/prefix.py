"""Running features: each row sees the rows of its learner and course up to itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradeloom.functions.scalars import exam_flags, fails, grade_per_score, task_flags, timings
from gradeloom.operators.blocks import before_block, range_blocks
from gradeloom.operators.collapse import order_key
from gradeloom.schema import COUNTERS, EXAM_GROUPS, FEATURES, KEYS, MEASURES

ORDER = ["step", "tie_rank", "tie_name", "row_id"]
CALLS = {"min": "min", "max": "max", "mean": "avg", "std": "stddev_samp"}


def frame(keys: list[str]) -> str:
    """The rows of the same keys up to the current one."""
    return (
        f"(partition by {', '.join(keys)} order by {', '.join(ORDER)}"
        " rows between unbounded preceding and current row)"
    )


def measured(clean: DataFrame, groups: dict = EXAM_GROUPS, keep_null_hours: bool = False) -> DataFrame:
    """The cleaned log narrowed to keys, order, target, flags and measures."""
    wide = clean.withColumns({"target": fails(), **timings(keep_null_hours), **exam_flags(groups), **task_flags()})
    return wide.select(*KEYS, *order_key(), "target", *COUNTERS.values(), *MEASURES)


def running(rows: DataFrame, counters: dict = COUNTERS, measures: list[str] = MEASURES) -> DataFrame:
    """All running features over one window, for groups that fit a task."""
    w = frame(KEYS)
    return rows.selectExpr(
        *KEYS, "row_id", "tie_rank", "tie_name",
        f"first(target) over {w} as target",
        f"max(step) over {w} as step",
        *[f"cast(sum({flag}) over {w} as double) as {out}" for out, flag in counters.items()],
        *[f"{call}({m}) over {w} as {m}_{s}" for m in measures for s, call in CALLS.items()],
    )


# a part is null where a block, or all before it, has no value
MEET = {
    "min": "least({0}, {0}_before)", "max": "greatest({0}, {0}_before)",
    "sum": "coalesce({0}, 0) + coalesce({0}_before, 0)",
}


def part_calls(counters: dict, measures: list[str]) -> tuple[dict, dict]:
    """How each part is taken over some rows, and how parts of earlier and later rows are put together."""
    parts, fold = {"step_part": "max(step)"}, {"step_part": "max"}
    for out, flag in counters.items():
        parts[f"{out}_part"], fold[f"{out}_part"] = f"sum({flag})", "sum"
    for m in measures:
        for part, call, how in (
            ("min", f"min({m})", "min"), ("max", f"max({m})", "max"), ("n", f"count({m})", "sum"),
            ("dev", f"sum({m}_dev)", "sum"), ("sq", f"sum({m}_dev * {m}_dev)", "sum"),
        ):
            parts[f"{m}_{part}_part"], fold[f"{m}_{part}_part"] = call, how
    return parts, fold


def features_of_parts(counters: dict, measures: list[str]) -> list[str]:
    """The running features as expressions of the parts and centres."""
    stats = []
    for m in measures:
        n, dev, sq = (f"{m}_{p}_part" for p in ("n", "dev", "sq"))
        stats += [
            f"{m}_min_part as {m}_min",
            f"{m}_max_part as {m}_max",
            f"if({n} > 0, {m}_centre + {dev} / {n}, null) as {m}_mean",
            f"if({n} > 1, sqrt(greatest({sq} - {dev} * {dev} / {n}, 0.0D) / ({n} - 1)), null) as {m}_std",
        ]
    return ["step_part as step", *[f"cast({out}_part as double) as {out}" for out in counters], *stats]


def running_in_blocks(
    rows: DataFrame,
    counters: dict = COUNTERS,
    measures: list[str] = MEASURES,
    blocks: int | None = None,
) -> DataFrame:
    """The same features for groups of any size, see `blocks`.

    Sums of squares are taken around the group's first value: exactly 0 as long as values do not
    change, and no digits are lost on values far from 0.
    """
    cut = range_blocks(rows, KEYS, [F.col(c) for c in ORDER], blocks)
    group = cut.groupBy(*KEYS).agg(
        F.expr(f"min_by(target, struct({', '.join(ORDER)})) as target_first"),
        *[F.expr(f"min_by({m}, if({m} is null, null, struct({', '.join(ORDER)}))) as {m}_centre") for m in measures],
    )
    cut = cut.drop("target").join(group, KEYS).selectExpr("*", *[f"{m} - {m}_centre as {m}_dev" for m in measures])

    parts, fold = part_calls(counters, measures)
    totals = cut.groupBy(*KEYS, "block").agg(*[F.expr(f"{call} as {n}") for n, call in parts.items()])
    earlier = before_block(totals, KEYS, {f"{n}_before": f"{how}({n})" for n, how in fold.items()})
    w = frame([*KEYS, "block"])
    here = cut.selectExpr(
        *KEYS, "block", "row_id", "tie_rank", "tie_name", "target_first",
        *[f"{m}_centre" for m in measures],
        *[f"{call} over {w} as {n}" for n, call in parts.items()],
    ).join(earlier, [*KEYS, "block"])

    whole = here.selectExpr(
        *KEYS, "row_id", "tie_rank", "tie_name", "target_first", *[f"{m}_centre" for m in measures],
        *[f"{MEET[how].format(n)} as {n}" for n, how in fold.items()],
    )
    return whole.selectExpr(
        *KEYS, "row_id", "tie_rank", "tie_name", "target_first as target", *features_of_parts(counters, measures))


def useful(features: DataFrame) -> DataFrame:
    """Rows from the first exam or task on."""
    return features.where("tasks_sum > 0 or exams_sum > 0")


def finished(features: DataFrame) -> DataFrame:
    """Ratio added, rows without exam or task left out, nulls as 0."""
    ready = useful(features.withColumn("grade_per_score", grade_per_score()))
    return ready.selectExpr(
        *KEYS, "row_id", "tie_rank", "tie_name", "target", *[f"coalesce({f}, 0.0D) as {f}" for f in FEATURES]
    )


def latest(features: DataFrame) -> DataFrame:
    """The first row of each learner and course that reaches its highest step.

    Kept as an aggregate over whole rows, combined before the shuffle, so it needs no window.
    """
    rest = [c for c in features.columns if c not in KEYS]
    order = F.struct(-F.col("step"), "tie_rank", "tie_name", "row_id")
    picked = features.groupBy(*KEYS).agg(F.min_by(F.struct(*rest), order).alias("row"))
    return picked.select(*KEYS, "row.*")


def numeric_only(df: DataFrame) -> DataFrame:
    """Numeric columns, the model's input."""
    from pyspark.sql.types import NumericType

    return df.select([f.name for f in df.schema if isinstance(f.dataType, NumericType)])

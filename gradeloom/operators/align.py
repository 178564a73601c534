"""Bring each submission together with the creation of its task.

A submission takes the creation columns of every creation of the same name of its learner and
course. The pairs are never spelled out: the creations of a name are first reduced to one row, and a
submission carries `weight`, the number of its pairs. Means over pairs are weighted means, so the
collapse that follows gives what the pairs would give, and a name with n submissions and m creations
costs n + m rows, not n * m.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradeloom.schema import CREATION_COLUMNS, KEYS

CARRIED = [c for c in CREATION_COLUMNS if c != "task_points"]


def task_names(log: DataFrame) -> DataFrame:
    """One row per learner, course and task name: was it created, how often, was it submitted."""
    roles = (
        log.where("task_name is not null or sub_task_name is not null")
        .selectExpr(
            *KEYS, "row_id", *CREATION_COLUMNS,
            "explode(array(struct(task_name as name, true as creation),"
            " struct(sub_task_name as name, false as creation))) as role",
        )
        .where("role.name is not null")
        .selectExpr(*KEYS, "row_id", *CREATION_COLUMNS, "role.name", "role.creation")
    )
    return roles.groupBy(*KEYS, "name").agg(*[F.expr(e) for e in (
        "count_if(creation) as creations",
        "count_if(not creation) as submissions",
        "sum(if(creation, task_points, null)) as name_points_sum",
        "count(if(creation, task_points, null)) as name_points_n",
        *[f"min_by({c}, if(creation and {c} is not null, row_id, null)) as name_{c}" for c in CARRIED],
    )])


def align(log: DataFrame) -> DataFrame:
    """Submissions with their creations, unsubmitted creations as zero scores, the rest blanked.

    `task_points` leaves as sum and count over the pairs, `tie_rank` tells submissions (1) from other
    rows (0). The join may split a hot name.
    """
    names = task_names(log).withColumnsRenamed({k: f"name_{k}" for k in KEYS})
    own_name = F.coalesce(F.col("sub_task_name"), F.col("task_name"))
    met = log.join(
        names,
        [F.col(k) == F.col(f"name_{k}") for k in KEYS] + [own_name == F.col("name")],
        "left",
    )
    return filled(met, log.columns)


def align_in_place(log: DataFrame) -> DataFrame:
    """The same for a log that lies by (learner, course) in groups that fit a task: no exchange, no join.

    A row that creates one task and submits another is doubled, so that its creation is seen under
    the other name; the double leaves again.
    """
    own = "coalesce(sub_task_name, task_name)"
    doubled = log.selectExpr(
        "*",
        "inline(filter(array("
        f"named_struct('name', {own}, 'own', true, 'creation', coalesce(task_name = {own}, false)),"
        " named_struct('name', task_name, 'own', false, 'creation', true)),"
        " r -> r.own or task_name <> sub_task_name))",
    )
    w = (
        f"(partition by {', '.join(KEYS)}, name order by row_id"
        " rows between unbounded preceding and unbounded following)"
    )
    met = doubled.selectExpr(
        *log.columns, "own",
        f"count_if(creation) over {w} as creations",
        f"count_if(own and sub_task_name is not null) over {w} as submissions",
        f"sum(if(creation, task_points, null)) over {w} as name_points_sum",
        f"count(if(creation, task_points, null)) over {w} as name_points_n",
        *[f"first(if(creation, {c}, null), true) over {w} as name_{c}" for c in CARRIED],
    )
    return filled(met.where("own"), log.columns)


def filled(met: DataFrame, columns: list[str]) -> DataFrame:
    """Log rows that know their task name's creations and submissions, put right."""
    roles = met.selectExpr(
        "*",
        "sub_task_name is not null as submission",
        "sub_task_name is null and task_name is not null and submissions > 0 as used",
        "sub_task_name is null and task_name is not null and submissions = 0 as missed",
    )
    changed = {*CREATION_COLUMNS, "sub_task_name", "sub_score"}
    return roles.selectExpr(
        *[c for c in columns if c not in changed],
        *[f"case when submission then name_{c} when not used then {c} end as {c}" for c in CARRIED],
        "case when submission then name_points_sum when not used then task_points end as points_sum",
        "case when submission then coalesce(name_points_n, 0L)"
        " when not used and task_points is not null then 1L else 0L end as points_n",
        "if(missed, task_name, sub_task_name) as sub_task_name",
        "if(missed, 0.0D, sub_score) as sub_score",
        "if(submission, greatest(coalesce(creations, 0L), 1L), 1L) as weight",
        "if(submission, 1, 0) as tie_rank",
    )

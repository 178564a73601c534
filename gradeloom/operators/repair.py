"""Row-wise repair of the raw log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradeloom.functions.scalars import graded, instant, repaired_term
from gradeloom.schema import EPOCH_COLUMNS, KEYS


def repair(activity: DataFrame) -> DataFrame:
    """Terms, steps, instants and missing grades put right; rows without learner or course left out."""
    changes = {c: instant(c) for c in EPOCH_COLUMNS}
    changes |= {
        "term": repaired_term(),
        "step": F.coalesce("step", F.lit(0.0)),
        "exam_grade": graded("exam_grade", "exam_name"),
        "sub_score": graded("sub_score", "sub_task_name"),
    }
    return activity.dropna(subset=KEYS).withColumns(changes)


def malformed_terms(activity: DataFrame) -> DataFrame:
    """How many rows carry a term that cannot be repaired."""
    bad = F.col("term").isNotNull() & repaired_term().isNull()
    return activity.agg(F.count_if(bad).alias("malformed_terms"))

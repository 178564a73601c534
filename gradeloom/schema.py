"""Schemas and column groups of the activity log."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["learner_id", "course_id"]

EPOCH_COLUMNS = [
    "task_created_at", "task_due_at", "task_unlock_at", "task_lock_at",
    "sub_submitted_at", "sub_graded_at", "sub_created_at", "exam_table_at",
]

# what a creation brings to the submissions of the same task name
CREATION_COLUMNS = [
    "task_id", "task_name", "task_created_at", "task_due_at",
    "task_unlock_at", "task_lock_at", "task_points",
]

TEXT_COLUMNS = [
    "course_name", "learner_no", "term", "exam_name", "task_id", "task_name", "sub_task_name",
]

ACTIVITY = T.StructType(
    [T.StructField("row_id", T.LongType(), False)]
    + [T.StructField(c, T.StringType()) for c in
       ("learner_id", "course_id", "course_name", "learner_no", "term")]
    + [T.StructField("step", T.DoubleType()),
       T.StructField("exam_name", T.StringType()),
       T.StructField("exam_grade", T.DoubleType()),
       T.StructField("final_grade", T.DoubleType()),
       T.StructField("task_id", T.StringType()),
       T.StructField("task_name", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in EPOCH_COLUMNS[:4]]
    + [T.StructField("task_points", T.DoubleType()),
       T.StructField("sub_task_name", T.StringType()),
       T.StructField("sub_score", T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in EPOCH_COLUMNS[4:]]
)

# Exam names of each group, as they stand in the gradebook export.
EXAM_GROUPS = {
    "part_exam": ["PRIMER PARCIAL(20)", "SEGUNDO PARCIAL(20)"],
    "integrator": ["INTEGRADOR(30)"],
    "retake": ["RECUPERATORIO PRIMER PARCIAL(20)", "RECUPERATORIO SEGUNDO PARCIAL(20)"],
}

# Column names of the gradebook export, and ours.
EXPORT_COLUMNS = {
    "user_uuid": "learner_id",
    "course_uuid": "course_id",
    "course_name": "course_name",
    "legajo": "learner_no",
    "periodo": "term",
    "particion": "step",
    "nombre_examen": "exam_name",
    "nota_parcial": "exam_grade",
    "nota_final_materia": "final_grade",
    "assignment_id": "task_id",
    "ass_name": "task_name",
    "ass_created_at": "task_created_at",
    "ass_due_at": "task_due_at",
    "ass_unlock_at": "task_unlock_at",
    "ass_lock_at": "task_lock_at",
    "points_possible": "task_points",
    "ass_name_sub": "sub_task_name",
    "score": "sub_score",
    "s_submitted_at": "sub_submitted_at",
    "s_graded_at": "sub_graded_at",
    "s_created_at": "sub_created_at",
    "fecha_mesa_epoch": "exam_table_at",
}

# running sum -> 0/1 flag it adds up
COUNTERS = {
    "part_exams_sum": "part_exam_flag",
    "integrators_sum": "integrator_flag",
    "retakes_sum": "retake_flag",
    "exams_sum": "exam_flag",
    "tasks_sum": "task_flag",
    "zero_tasks_sum": "zero_task_flag",
}

# columns with running min, max, mean and std
MEASURES = [
    "part_exam_grade", "integrator_grade", "retake_grade", "exam_grade", "sub_score",
    "hours_allowed", "hours_taken", "share_taken", "hours_early",
]
STATISTICS = ["min", "max", "mean", "std"]

FEATURES = (
    ["step"]
    + list(COUNTERS)
    + [f"{m}_{s}" for m in MEASURES for s in STATISTICS]
    + ["grade_per_score"]
)

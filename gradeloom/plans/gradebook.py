"""A gradebook derived from the test data's `events` table, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EXAMS = {
    "part_exam": ["PART 1", "PART 2"],
    "integrator": ["FINAL PROJECT"],
    "retake": ["RETAKE 1", "RETAKE 2"],
}

COLUMNS = """
  event_id as row_id,
  concat('L', cast(user_id as string)) as learner_id,
  concat('C', cast(c as string)) as course_id,
  concat('Course ', cast(c % 3 as string)) as course_name,
  concat('N', cast(user_id as string)) as learner_no,
  concat(cast(1 + user_id % 12 as string), '-2024') as term,
  case when event_id % 97 <> 0 then cast(d as double) end as step,
  case when exam then case event_id % 5 when 0 then 'PART 1' when 1 then 'PART 2'
    when 2 then 'FINAL PROJECT' when 3 then 'RETAKE 1' else 'RETAKE 2' end end as exam_name,
  case when exam and k >= 10 then least(10.0D, value / 5.0D) end as exam_grade,
  case when (user_id + c) % 13 <> 0 then cast((user_id * 7 + c * 3) % 11 as double) end as final_grade,
  case when creation then concat('T', cast(event_id as string)) end as task_id,
  case when creation then concat('A', cast(k % 6 as string)) end as task_name,
  case when creation then ep - 3600 end as task_created_at,
  case when creation then ep + 86400 * (1 + k % 14) end as task_due_at,
  case when creation then case when k % 25 = 0 then 0 else ep end end as task_unlock_at,
  case when creation then ep + 86400 * (2 + k % 14) end as task_lock_at,
  case when creation then 10.0D end as task_points,
  case when submission then concat('A', cast(k % 6 as string)) end as sub_task_name,
  case when submission and k < 95 then least(10.0D, value / 5.0D) end as sub_score,
  case when submission then ep end as sub_submitted_at,
  case when submission then ep + 7200 end as sub_graded_at,
  case when submission then ep - 60 end as sub_created_at,
  case when exam then ep end as exam_table_at
"""


def gradebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id", "user_id", "value",
        "event_id % 4 as c",
        "cast(regexp_extract(props, '[0-9]+', 0) as int) as k",
        "unix_seconds(cast(ts as timestamp)) as ep",
        "datediff(cast(ts as date), DATE'2024-01-01') as d",
        "event_type = 'purchase' as exam",
        "event_type = 'view' as creation",
        "event_type = 'click' as submission",
    )
    return base.selectExpr(*[c.strip() for c in _split(COLUMNS)])


def _split(text: str) -> list[str]:
    """Cut a select list at its top-level commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(text[start:i])
            start = i + 1
    return out + [text[start:]]

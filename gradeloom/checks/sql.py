"""The registered queries as plain SQL, written row by row: pairs are spelled out, windows are plain.

`{...}` blocks are common table expressions, added in front of a query by `with_ctes`.
"""

from __future__ import annotations

from gradeloom.schema import COUNTERS, EPOCH_COLUMNS, FEATURES, MEASURES, TEXT_COLUMNS

KEYS = "learner_id, course_id"
MEANS = ["step", "exam_grade", "final_grade", "sub_score"]


def pin(expression: str, name: str) -> str:
    return f"floor(({expression}) * 100000.0::double + 0.50003::double) / 100000.0::double as {name}"


def pins(names) -> str:
    return ", ".join(pin(n, n) for n in names)


def exam(names: list[str]) -> str:
    return "exam_name in (" + ", ".join(f"'{n}'" for n in names) + ")"


ACTIVITY = """
base as (
  select event_id, user_id, value, event_id % 4 as c,
    cast(regexp_extract(props, '[0-9]+') as integer) as k,
    epoch_us(ts) // 1000000 as ep, date_diff('day', DATE '2024-01-01', cast(ts as date)) as d, event_type
  from events),
activity as (
  select event_id as row_id, 'L' || user_id as learner_id, 'C' || c as course_id,
    'Course ' || (c % 3) as course_name, 'N' || user_id as learner_no,
    (1 + user_id % 12) || '-2024' as term,
    case when event_id % 97 <> 0 then d::double end as step,
    case when event_type = 'purchase' then case event_id % 5 when 0 then 'PART 1' when 1 then 'PART 2'
      when 2 then 'FINAL PROJECT' when 3 then 'RETAKE 1' else 'RETAKE 2' end end as exam_name,
    case when event_type = 'purchase' and k >= 10 then least(10.0::double, value / 5.0::double) end as exam_grade,
    case when (user_id + c) % 13 <> 0 then ((user_id * 7 + c * 3) % 11)::double end as final_grade,
    case when event_type = 'view' then 'T' || event_id end as task_id,
    case when event_type = 'view' then 'A' || (k % 6) end as task_name,
    case when event_type = 'view' then ep - 3600 end as task_created_at,
    case when event_type = 'view' then ep + 86400 * (1 + k % 14) end as task_due_at,
    case when event_type = 'view' then case when k % 25 = 0 then 0 else ep end end as task_unlock_at,
    case when event_type = 'view' then ep + 86400 * (2 + k % 14) end as task_lock_at,
    case when event_type = 'view' then 10.0::double end as task_points,
    case when event_type = 'click' then 'A' || (k % 6) end as sub_task_name,
    case when event_type = 'click' and k < 95 then least(10.0::double, value / 5.0::double) end as sub_score,
    case when event_type = 'click' then ep end as sub_submitted_at,
    case when event_type = 'click' then ep + 7200 end as sub_graded_at,
    case when event_type = 'click' then ep - 60 end as sub_created_at,
    case when event_type = 'purchase' then ep end as exam_table_at
  from base)
"""

REPAIRED = f"""
repaired as (
  select row_id, {KEYS}, course_name, learner_no,
    case when len(string_split(term, '-')) = 2
      then right('0' || split_part(term, '-', 1), 2) || '-' || split_part(term, '-', 2) end as term,
    coalesce(step, 0) as step, exam_name,
    case when exam_name is not null and exam_grade is null then 0 else exam_grade end as exam_grade,
    final_grade, task_id, task_name, task_points, sub_task_name,
    case when sub_task_name is not null and sub_score is null then 0 else sub_score end as sub_score,
    {", ".join(f"nullif({c}, 0) as {c}" for c in EPOCH_COLUMNS)}
  from activity where learner_id is not null and course_id is not null)
"""

_CREATION = ["task_id", "task_name", "task_created_at", "task_due_at", "task_unlock_at", "task_lock_at", "task_points"]
_REST = [c for c in ["course_name", "learner_no", "term", "step", "exam_name", "exam_grade", "final_grade",
                     "sub_submitted_at", "sub_graded_at", "sub_created_at", "exam_table_at"]]
_rest = ", ".join(f"r.{c}" for c in _REST)

# one row for each pair of a submission and a creation
PAIRS = f"""
creations as (
  select row_id as match_id, {KEYS}, {", ".join(_CREATION)} from repaired where task_name is not null),
submitted as (
  select distinct {KEYS}, sub_task_name as name from repaired where sub_task_name is not null),
pairs as (
  select r.row_id, coalesce(c.match_id, -1) as match_id, r.learner_id, r.course_id, {_rest},
    {", ".join(f"c.{x}" for x in _CREATION)}, r.sub_task_name, r.sub_score, 1 as tie_rank
  from repaired r left join creations c on c.learner_id = r.learner_id and c.course_id = r.course_id
    and c.task_name = r.sub_task_name
  where r.sub_task_name is not null
  union all
  select r.row_id, -1, r.learner_id, r.course_id, {_rest},
    {", ".join(f"case when s.name is null then r.{x} end" for x in _CREATION)},
    case when s.name is null then r.task_name end,
    case when s.name is null and r.task_name is not null then 0 else r.sub_score end, 0
  from repaired r left join submitted s on s.learner_id = r.learner_id and s.course_id = r.course_id
    and s.name = r.task_name
  where r.sub_task_name is null)
"""


def folded(source: str, made: str, name: str, rank: int, order: str) -> str:
    """Groups of more than one row become their mean and first non-null values."""
    means = MEANS + ["task_points"]
    others = [c for c in TEXT_COLUMNS if c != name] + EPOCH_COLUMNS
    plain = ", ".join(["row_id", "match_id", KEYS, "tie_rank", name, *means, *others])
    made_means = ", ".join(f"avg({c}) as {c}" for c in means)
    firsts = ", ".join(f"first({c} order by {order}) filter (where {c} is not null) as {c}" for c in others)
    return f"""
{made}_counted as (
  select *, case when {name} is null then 1 else count(*) over (partition by {KEYS}, {name}) end as members
  from {source}),
{made} as (
  select {plain} from {made}_counted where members = 1
  union all
  select min(row_id), -1, {KEYS}, {rank}, {name}, {made_means}, {firsts}
  from {made}_counted where members > 1 group by {KEYS}, {name})
"""


CLEAN = (
    folded("pairs", "exams_folded", "exam_name", 2, "step, tie_rank, row_id, match_id")
    + ","
    + folded(
        "exams_folded", "clean", "sub_task_name", 3,
        "tie_rank = 2, case when tie_rank = 2 then 0 else step end, case when tie_rank = 2 then 0 else tie_rank end,"
        " case when tie_rank = 2 then exam_name else '' end, row_id, match_id",
    )
)


def hours(later: str, earlier: str, empty: str) -> str:
    value = f"case when task_name is not null then ({later} - {earlier}) / 3600.0::double end"
    return f"coalesce({value}, 0)" if empty == "0" else value


def measured(empty: str = "0") -> str:
    share = "case when hours_allowed > 0 then hours_taken / hours_allowed end"
    share = f"coalesce({share}, 0)" if empty == "0" else share
    return f"""
timed as (
  select *, {hours("task_due_at", "task_unlock_at", empty)} as hours_allowed,
    {hours("sub_submitted_at", "task_unlock_at", empty)} as hours_taken,
    {hours("task_due_at", "sub_submitted_at", empty)} as hours_early
  from clean),
measured as (
  select *, {share} as share_taken,
    case when final_grade >= 4 then 0 else 1 end as target,
    case tie_rank when 2 then exam_name when 3 then sub_task_name else '' end as tie_name,
    coalesce(({exam(["PART 1", "PART 2"])})::int, 0) as part_exam_flag,
    coalesce(({exam(["FINAL PROJECT"])})::int, 0) as integrator_flag,
    coalesce(({exam(["RETAKE 1", "RETAKE 2"])})::int, 0) as retake_flag,
    (exam_name is not null)::int as exam_flag,
    (sub_task_name is not null)::int as task_flag,
    coalesce((sub_task_name is not null and sub_score <= 0)::int, 0) as zero_task_flag,
    case when {exam(["PART 1", "PART 2"])} then exam_grade end as part_exam_grade,
    case when {exam(["FINAL PROJECT"])} then exam_grade end as integrator_grade,
    case when {exam(["RETAKE 1", "RETAKE 2"])} then exam_grade end as retake_grade
  from timed)
"""


_FUNCTIONS = {"min": "min", "max": "max", "mean": "avg", "std": "stddev_samp"}
RUNNING = f"""
running as (
  select {KEYS}, row_id, tie_rank, tie_name, first(target) over w as target, max(step) over w as step,
    {", ".join(f"sum({f}) over w as {o}" for o, f in COUNTERS.items())},
    {", ".join(f"{fn}({m}) over w as {m}_{s}" for m in MEASURES for s, fn in _FUNCTIONS.items())}
  from measured
  window w as (partition by {KEYS} order by step, tie_rank, tie_name, row_id
    rows between unbounded preceding and current row)),
features as (
  select {KEYS}, row_id, tie_rank, tie_name, target, step,
    {", ".join(f"coalesce({c}, 0)::double as {c}" for c in FEATURES[1:-1])},
    coalesce(case when sub_score_mean > 0 then 100 * exam_grade_mean / sub_score_mean else 0 end, 0)
      as grade_per_score
  from running where tasks_sum > 0 or exams_sum > 0)
"""

LABELLED = f"""
labelled as (
  select row_id, {KEYS}, case when final_grade >= 4 then 0 else 1 end as target, step, exam_grade from activity)
"""


def ranked(seed: int, source: str = "labelled", by: str = "target", id_column: str = "row_id") -> str:
    part = f"partition by {by}" if by else ""
    return f"""
ranked as (
  select *, row_number() over ({part} order by md5({id_column} || ':{seed}'), {id_column}) as rank,
    count(*) over ({part}) as class_size
  from {source})
"""


SCORED = f"""
scored as (
  select a.row_id, {KEYS}, case when final_grade >= 4 then 0 else 1 end as target,
    ((user_id * 37 + (event_id % 4) * 11 + event_id) % 101) / 100.0::double as p
  from activity a join events e on e.event_id = a.row_id)
"""

PREDICTIONS = f"""
predictions as (
  select {KEYS}, max(step) as step,
    case when count(*) % 7 <> 0 then (count(*) * 13 % 101) / 100.0::double end as p
  from activity group by {KEYS}),
verdicts as (
  select *, round_even(100 * p, 1) as fail_pct,
    case when round_even(100 * p, 1) >= 0.42::double * 100 then 'Fail' else 'Pass' end as verdict
  from predictions where p is not null)
"""

SUMMARY = """
summary as (
  select learner_id, first(learner_no order by course_id, step, tie_rank, tie_name, row_id) as learner_no,
    first(course_name order by course_id, step, tie_rank, tie_name, row_id) as course_name,
    round_even(round(avg(exam_grade), 9), 1) as mean_grade, round_even(round(avg(sub_score), 9), 1) as mean_score
  from measured group by learner_id)
"""

ROC = """
steps as (
  select p, sum(target) as pos, sum(1 - target) as neg from scored group by p),
curve as (
  select p, pos, neg, sum(pos) over (order by p desc) as tp, sum(neg) over (order by p desc) as fp,
    sum(pos) over () as positives, sum(neg) over () as negatives
  from steps),
points as (
  select null::double as threshold, 0::double as fpr, 0::double as tpr
  union all
  select p, fp::double / negatives, tp::double / positives from curve)
"""


def confusion(cutoff: str) -> str:
    return (
        f"count(*) filter (where p > {cutoff} and target = 1) as tp, "
        f"count(*) filter (where p > {cutoff} and target = 0) as fp, "
        f"count(*) filter (where p <= {cutoff} and target = 1) as fn, "
        f"count(*) filter (where p <= {cutoff} and target = 0) as tn"
    )


QUALITY = {
    "precision": "coalesce(tp::double / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp::double / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp::double / nullif(2 * tp + fp + fn, 0), 0)",
    "accuracy": "coalesce((tp + tn)::double / nullif(tp + fp + fn + tn, 0), 0)",
}
_quality = ", ".join(pin(e, n) for n, e in QUALITY.items())

SWEEP = f"""
cutoffs as (select i / 100.0::double as cutoff from range(30, 61) t(i)),
swept as (select cutoff, {confusion("cutoff")} from scored, cutoffs group by cutoff),
swept_f1 as (select *, {QUALITY["f1"]} as f1_exact from swept)
"""

RUN_SCORES = f"""
run_scores as (select *, 'R' || (row_id % 5) as run_id from scored),
run_confusion as (select run_id, {confusion("0.5")} from run_scores group by run_id),
run_steps as (
  select run_id, p, sum(target) as pos, sum(1 - target) as neg from run_scores group by run_id, p),
run_curve as (
  select *, sum(pos) over (partition by run_id order by p desc) as tp, sum(pos) over (partition by run_id) as positives,
    sum(neg) over (partition by run_id) as negatives from run_steps),
run_auc as (
  select run_id, sum(neg * (tp - pos / 2.0::double)) / max(positives::double * negatives) as roc_auc
  from run_curve group by run_id)
"""

RUNS = """
runs as (
  select 'R' || p_partkey as run_id,
    case p_partkey % 3 when 0 then 'random_forest' when 1 then 'boosted_fine' else 'boosted_coarse' end as algorithm,
    case when p_partkey % 50 = 7 then 'production' when p_partkey % 5 = 1 then 'staging'
      when p_partkey % 7 <> 3 then 'development' end as stage,
    ((p_partkey * 37 + p_size) % 1000) / 1000.0::double as roc_auc,
    ((p_partkey * 53 + p_size) % 1000) / 1000.0::double as f1,
    ((p_partkey * 71 + p_size) % 1000) / 1000.0::double as "precision",
    ((p_partkey * 89 + p_size) % 1000) / 1000.0::double as recall,
    ((p_partkey * 97 + p_size) % 1000) / 1000.0::double as accuracy,
    [(p_partkey * 41 % 1000) / 1000.0::double, ((p_partkey * 41 + 13) % 1000) / 1000.0::double,
      ((p_partkey * 41 + 26) % 1000) / 1000.0::double, ((p_partkey * 41 + 39) % 1000) / 1000.0::double] as cv_scores,
    ((p_partkey * 43) % 1000) / 1000.0::double as val_score,
    ((p_partkey * 61) % 1000) / 1000.0::double as test_score
  from part),
crown as (select * from runs where stage = 'production' order by test_score desc, run_id limit 1),
candidates as (
  select *, row_number() over (order by test_score desc, run_id) as place
  from (select * from runs where run_id not in (select run_id from crown) order by val_score desc, run_id limit 10))
"""



def staged(source: str, n: int) -> str:
    """Stages anew for rows of a run and version: `staged` adds new_stage."""
    return f"""
crowned as (select run_id, version, test_score from {source} where stage = 'production' order by test_score desc, run_id, version limit 1),
pool as (
  select * from {source} where stage is not null and (run_id, version) not in (select run_id, version from crowned)),
challengers as (
  select *, row_number() over (order by test_score desc, run_id, version) as place
  from (select * from pool order by val_score desc, run_id, version limit {n})),
winner as (
  select run_id, version from challengers
  where place = 1 and not exists (select 1 from crowned where crowned.test_score >= challengers.test_score)),
staged as (
  select s.*, case
    when s.stage is null then null
    when (s.run_id, s.version) in (select run_id, version from winner) then 'production'
    when (s.run_id, s.version) in (select run_id, version from crowned) then
      case when exists (select 1 from winner) then 'staging' else 'production' end
    when (s.run_id, s.version) in (select run_id, version from challengers) then 'staging'
    else 'development' end as new_stage
  from {source} s)
"""


BOARD = ["roc_auc", "f1", "precision", "recall", "accuracy"]

SMOTE = """
customers as (
  select c_custkey as row_id, c_nationkey::double as a, floor(c_acctbal / 100) as b,
    case when c_custkey % 3 = 0 then 1 else 0 end as target from customer),
sizes as (
  select count(*) filter (where target = 1) as have,
    count(*) filter (where target = 0) - count(*) filter (where target = 1) as lack from customers),
minority as (
  select *, row_number() over (order by md5(row_id || ':0'), row_id) as rank,
    min(row_id) over (partition by a, b) as vid from customers where target = 1),
near as (
  select x.row_id, y.vid as nid, y.a, y.b,
    row_number() over (partition by x.row_id
      order by y.vid <> x.vid, (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b), y.vid, y.row_id) as number
  from minority x join minority y on x.row_id <> y.row_id),
draws as (
  select row_id, a, b, rank, unnest(range(1, (lack // have + case when rank <= lack % have then 1 else 0 end + 1)::bigint)) as turn
  from minority, sizes),
placed as (
  select *, (rank + turn) % 5 + 1 as number, ((rank * 48271 + turn * 16807) % 65521) / 65521.0::double as u from draws)
"""


def with_ctes(ctes: list[str], select: str) -> str:
    return "with " + ",".join(ctes) + "\n" + select


BASE = [ACTIVITY]
LOG = BASE + [REPAIRED]
PAIRED = LOG + [PAIRS]
CLEANED = PAIRED + [CLEAN]
MEASURED = CLEANED + [measured()]
FEATURED = MEASURED + [RUNNING]
LABELS = BASE + [LABELLED]
SCORES = BASE + [SCORED]
PREDICTED = BASE + [PREDICTIONS]

_doubles = ["step", "exam_grade", "final_grade", "task_points", "sub_score"]
_activity = f"""row_id, {KEYS}, course_name, learner_no, term, exam_name, task_id, task_name, sub_task_name,
  {", ".join(EPOCH_COLUMNS)}, {pins(_doubles)}"""
_clean = f"""row_id, {KEYS}, tie_rank, {", ".join(TEXT_COLUMNS)}, {", ".join(EPOCH_COLUMNS)},
  {pins(MEANS + ["task_points"])}"""
# pairs of one submission together again
_aligned = f"""select row_id, {KEYS}, tie_rank, count(*) as weight, {pin("any_value(step)", "step")},
  {", ".join(f"first({c} order by match_id) filter (where {c} is not null) as {c}" for c in _CREATION if c != "task_points")},
  {pin("sum(task_points)", "points_sum")}, count(task_points) as points_n, any_value(sub_task_name) as sub_task_name,
  {pin("any_value(sub_score)", "sub_score")}
from pairs"""
_feature_rows = f"{KEYS}, row_id, tie_rank, target, {pins(FEATURES)}"
_hours = ["hours_allowed", "hours_taken", "share_taken", "hours_early"]
_magnitudes = "magnitudes as (" + " union all ".join(
    f"select '{f}' as feature, round(avg(abs({f})), 9) as importance from features" for f in FEATURES
) + """),
importance as (
  select row_number() over (order by importance desc, feature) as place, feature, importance,
    sum(importance) over (order by importance desc, feature rows between unbounded preceding and current row)
      / sum(importance) over () as running_share
  from magnitudes)"""
_cleaned_log = with_ctes(CLEANED, f"select {_clean} from clean")
_prefix = with_ctes(FEATURED, f"select {_feature_rows} from features")
_pick = """
course_pick as (select course_name from activity group by 1 order by md5(course_name || ':7'), course_name limit 1),
in_course as (select * from activity semi join course_pick using (course_name)),
learner_pick as (select learner_id from in_course group by 1 order by md5(learner_id || ':7'), learner_id limit 1),
of_learner as (select * from in_course semi join learner_pick using (learner_id)),
step_pick as (
  select step from of_learner where step > 15 group by 1 order by md5(step::varchar || ':7'), step limit 1)
"""

SQL = {
    "scan_activity": with_ctes(BASE, f"select {_activity} from activity"),
    "scan_clean_log": with_ctes(CLEANED, f"""
select row_id, {KEYS}, {pins(["step"])}, exam_name, {pins(["exam_grade"])}, sub_task_name, {pins(["sub_score"])}
from clean where course_name = 'Course 1' and step <= 15"""),
    "course_filter": with_ctes(BASE, f"select row_id, {KEYS} from activity where course_name = 'Course 0'"),
    "learner_filter": with_ctes(BASE, f"""
select row_id, {KEYS}, {pins(["step"])} from activity where learner_id in ('L3', 'L14', 'L15')"""),
    "learner_table_filter": with_ctes(BASE, f"""
select row_id, {KEYS} from activity where learner_id in (select 'L' || n_nationkey from nation)"""),
    "step_filter": with_ctes(BASE, f"select row_id, {pins(['step'])} from activity where step <= 10"),
    "step_filter_null_as_zero": with_ctes(BASE, f"""
select row_id, {pins(["step"])} from activity where step <= 10 or step is null"""),
    "term_filter": with_ctes(BASE, "select row_id, term from activity where term = '3-2024'"),
    "random_course_learner_step": with_ctes(BASE + [_pick], f"""
select row_id, {KEYS}, course_name, {pins(["step"])} from of_learner where step <= (select step from step_pick)"""),
    "zero_for_missing_grades": with_ctes(LOG, f"""
select row_id, exam_name, {pins(["exam_grade"])}, sub_task_name, {pins(["sub_score"])} from repaired"""),
    "useful_rows": with_ctes(FEATURED, f"""
select row_id, {KEYS}, tasks_sum, exams_sum from (
  select row_id, {KEYS}, {pins(["tasks_sum", "exams_sum"])} from features)"""),
    "nulls_to_zero": with_ctes(BASE, f"""
select row_id, {", ".join(pin(f"coalesce({c}, 0)", c) for c in ("step", "exam_grade", "final_grade"))} from activity"""),
    "numeric_columns": with_ctes(BASE, f"""
select row_id, {pins(_doubles)}, {", ".join(EPOCH_COLUMNS)} from activity"""),
    "renamed_columns": with_ctes(BASE, f"""
select row_id, learner_no as number, {pin("exam_grade", "grade")} from activity"""),
    "predicted_rows": with_ctes(PREDICTED, f"""
select {KEYS}, {pins(["step", "p"])} from predictions where p is not null"""),
    "repeated_exam_rows": with_ctes(LOG, f"""
select row_id, {KEYS}, exam_name, copies from (
  select *, count(*) over (partition by {KEYS}, exam_name) as copies from repaired where exam_name is not null)
where copies > 1"""),
    "term_repair": with_ctes(LOG, "select term, count(*) as rows from repaired group by term"),
    "term_faults": with_ctes(BASE, """
select count(*) filter (where len(string_split(term, '-')) <> 2) as malformed_terms from activity"""),
    "steps_and_instants": with_ctes(LOG, f"select row_id, {pins(['step'])}, {', '.join(EPOCH_COLUMNS)} from repaired"),
    "targets": with_ctes(BASE, """
select row_id, case when final_grade >= 4 then 0 else 1 end as target, (final_grade is not null)::int as has_final
from activity"""),
    "task_timings": with_ctes(MEASURED, f"select row_id, {pins(_hours)} from measured"),
    "task_timings_with_nulls": with_ctes(CLEANED + [measured("null")], f"select row_id, {pins(_hours)} from measured"),
    "exam_and_task_flags": with_ctes(MEASURED, f"""
select row_id, {", ".join(COUNTERS.values())}, {pins(["part_exam_grade", "integrator_grade", "retake_grade"])}
from measured"""),
    "verdict_of_predictions": with_ctes(PREDICTED, f"select {KEYS}, {pins(['fail_pct'])}, verdict from verdicts"),
    "logits": f"select event_id, {pin('1 / (1 + exp(-((value - 5.0::double) / 4.0::double)))', 'p')} from events",
    "request_round_trip": with_ctes(BASE, f"select {_activity} from activity"),
    "response_rows": with_ctes(PREDICTED, f"select {KEYS}, {pins(['p'])} from predictions where p is not null"),
    "aligned_log": with_ctes(PAIRED, f"{_aligned} group by row_id, {KEYS}, tie_rank"),
    "aligned_submissions": with_ctes(PAIRED, f"{_aligned} where tie_rank = 1 group by row_id, {KEYS}, tie_rank"),
    "unsubmitted_creations": with_ctes(LOG, f"""
select row_id, {KEYS}, task_name, task_name as sub_task_name, 0::double as sub_score from repaired r
where task_name is not null and sub_task_name is null and not exists (
  select 1 from repaired s where s.learner_id = r.learner_id and s.course_id = r.course_id
    and s.sub_task_name = r.task_name)"""),
    "submitted_creations": with_ctes(LOG, f"""
select row_id, {KEYS}, {pins(["step"])}, 0 as points_n from repaired r
where task_name is not null and sub_task_name is null and exists (
  select 1 from repaired s where s.learner_id = r.learner_id and s.course_id = r.course_id
    and s.sub_task_name = r.task_name)"""),
    "names_created_never_submitted": with_ctes(LOG, f"""
select {KEYS}, task_name as name, count(*) as creations from repaired r where task_name is not null and not exists (
  select 1 from repaired s where s.learner_id = r.learner_id and s.course_id = r.course_id
    and s.sub_task_name = r.task_name)
group by {KEYS}, task_name"""),
    "collapsed_exams": with_ctes(CLEANED, f"""
select row_id, {KEYS}, tie_rank, {pins(["step"])}, exam_name, {pins(["exam_grade"])}, course_name, exam_table_at
from exams_folded where exam_name is not null"""),
    "cleaned_log": _cleaned_log,
    "cleaned_log_hot_groups": _cleaned_log,
    "ordered_log": with_ctes(CLEANED, f"""
select row_id, {KEYS}, {pins(["step"])}, tie_rank from clean order by {KEYS}, clean.step"""),
    "prefix_features": _prefix,
    "prefix_features_hot_groups": _prefix,
    "prefix_features_null_hours": with_ctes(CLEANED + [measured("null"), RUNNING], f"""
select row_id, {pins([f for f in FEATURES if f.startswith(("hours_", "share_"))])} from features"""),
    "prefix_exam_features": with_ctes(LOG, f"""
select row_id, count(exam_grade) over w as exams, {pin("min(exam_grade) over w", "grade_min")},
  {pin("max(exam_grade) over w", "grade_max")}, {pin("avg(exam_grade) over w", "grade_mean")},
  {pin("stddev_samp(exam_grade) over w", "grade_std")}
from repaired
window w as (partition by {KEYS} order by step, row_id rows between unbounded preceding and current row)"""),
    "latest_rows": with_ctes(FEATURED, f"""
select {_feature_rows} from (
  select *, row_number() over (partition by {KEYS} order by step desc, tie_rank, tie_name, row_id) as newest
  from features) where newest = 1"""),
    "feature_magnitudes": with_ctes(FEATURED + [_magnitudes], f"""
select place, feature, {pins(["importance", "running_share"])} from importance"""),
    "top_magnitudes": with_ctes(FEATURED + [_magnitudes], f"""
select place, feature, {pins(["importance", "running_share"])} from importance where place <= 20"""),
    "learner_summaries": with_ctes(MEASURED + [SUMMARY], f"""
select learner_id, learner_no, course_name, {pins(["mean_grade", "mean_score"])} from summary"""),
    "prediction_reports": with_ctes(MEASURED + [SUMMARY, PREDICTIONS], f"""
select learner_id, course_id, {pins(["step", "p", "fail_pct"])}, verdict, learner_no, course_name,
  {pins(["mean_grade", "mean_score"])} from verdicts left join summary using (learner_id)"""),
    "verdict_share": with_ctes(PREDICTED, f"""
select {pin("100 * avg((verdict = 'Pass')::int)", "pass_pct")}, {pin("100 * avg((verdict = 'Fail')::int)", "fail_pct")}
from verdicts"""),
    "course_options": with_ctes(BASE, "select course_name, count(*) as rows from activity group by 1"),
    "activity_facts": with_ctes(BASE, f"""
select count(*) as events, count(distinct course_name) as courses, count(distinct learner_no) as learners,
  {pin("min(step)", "first_step")}, {pin("max(step)", "last_step")} from activity"""),
    "prediction_sink_rows": with_ctes(PREDICTED, f"""
select {KEYS}, case when (select count(distinct course_name) from activity) > 1 then 'all'
  else (select min(course_name) from activity) end as course_name,
  {pin("(select max(step) from activity)", "step")}, {pins(["p"])} from predictions"""),
    "class_balance": with_ctes(LABELS, f"""
select target, count(*) as rows, {pin("count(*)::double / (select count(*) from labelled)", "share")}
from labelled group by target"""),
    "train_test_split": with_ctes(LABELS + [ranked(20240601)], """
select row_id, target, case when rank <= 0.2::double * class_size then 'test' else 'train' end as split from ranked"""),
    "train_test_split_by_learner": with_ctes(
        LABELS + ["learners as (select distinct learner_id from labelled)",
                  ranked(20240601, "learners", "", "learner_id")], """
select row_id, learner_id, case when rank <= 0.2::double * class_size then 'test' else 'train' end as split
from labelled join ranked using (learner_id)"""),
    "fold_numbers": with_ctes(LABELS + [ranked(20240601)], "select row_id, target, (rank - 1) % 4 as fold from ranked"),
    "oversampled": with_ctes(LABELS + [ranked(0)], """
select row_id, target, unnest(range(1, (top // class_size + case when rank <= top % class_size then 1 else 0 end + 1)::bigint))
  as copy
from ranked, (select max(class_size) as top from ranked)"""),
    "undersampled": with_ctes(LABELS + [ranked(0)], """
select row_id, target from ranked where rank <= (select min(class_size) from ranked)"""),
    "smote_rows": with_ctes([SMOTE], f"""
select d.row_id as base_id, turn, d.number, nid as neighbour_id, {pins(["u"])},
  {pin("d.a + u * (n.a - d.a)", "a")}, {pin("d.b + u * (n.b - d.b)", "b")}, 1 as target
from placed d join near n on n.row_id = d.row_id and n.number = d.number"""),
    "confusion_matrix": with_ctes(SCORES, f"select {confusion('0.5')} from scored"),
    "quality_at_cutoff": with_ctes(SCORES, f"""
select tp, fp, fn, tn, {_quality}, {pin("(tp::double / (tp + fn) + tn::double / (tn + fp)) / 2", "hard_auc")}
from (select {confusion("0.37::double")} from scored)"""),
    "predicted_class": with_ctes(SCORES, "select row_id, case when p > 0.5 then 1 else 0 end as predicted from scored"),
    "roc_curve": with_ctes(SCORES + [ROC], f"select {pins(['threshold', 'fpr', 'tpr'])} from points"),
    "roc_auc": with_ctes(SCORES + [ROC], f"""
select {pin("sum(neg * (tp - pos / 2.0::double)) / max(positives::double * negatives)", "roc_auc")} from curve"""),
    "area_under_points": with_ctes(SCORES + [ROC], f"""
select {pin("sum(slab)", "area")} from (
  select (fpr - lag(fpr) over (order by fpr, tpr)) * (tpr + lag(tpr) over (order by fpr, tpr)) / 2 as slab from points)"""),
    "cutoff_sweep": with_ctes(SCORES + [SWEEP], f"select {pins(['cutoff'])}, tp, fp, fn, tn, {_quality} from swept"),
    "best_cutoff": with_ctes(SCORES + [SWEEP], f"""
select {pins(["cutoff"])}, {pin("f1_exact", "f1")} from swept_f1 order by f1_exact desc, swept_f1.cutoff limit 1"""),
    "candidates_on_test": with_ctes(SCORES + [RUN_SCORES], f"""
select run_id, tp, fp, fn, tn, {_quality}, {pins(["roc_auc"])} from run_confusion join run_auc using (run_id)"""),
    "main_score": with_ctes(SCORES + [RUN_SCORES], f"select run_id, {pin(QUALITY['f1'], 'test_score')} from run_confusion"),
    "run_query": with_ctes([RUNS], f"select run_id, algorithm, {pins(['val_score'])} from runs where stage = 'staging'"),
    "run_lookup": with_ctes([RUNS], f"select run_id, stage, {pins(['val_score'])} from runs where run_id = 'R17'"),
    "runs_of_stages": with_ctes([RUNS], f"""
select run_id, stage, {pins(["test_score"])} from runs where stage = 'staging'
union all select run_id, stage, {pins(["test_score"])} from runs where stage = 'production'"""),
    "mean_fold_scores": with_ctes([RUNS], f"select run_id, {pin('list_avg(cv_scores)', 'mean_score')} from runs"),
    "top_runs_per_algorithm": with_ctes([RUNS], f"""
select run_id, algorithm, {pins(["val_score"])}, place from (
  select *, row_number() over (partition by algorithm order by val_score desc, run_id) as place from runs)
where place <= 3"""),
    "staging_candidates": with_ctes([RUNS], f"""
select run_id, {pins(["val_score", "test_score"])}, row_number() over (order by best.test_score desc, run_id) as place
from (select * from runs order by val_score desc, run_id limit 10) best"""),
    "current_champion": with_ctes([RUNS], f"select run_id, {pins(['test_score'])} from crown"),
    "assigned_stages": with_ctes([RUNS, "numbered as (select run_id, 1 as version, stage, val_score, test_score from runs)",
                               staged("numbered", 10)], "select run_id, new_stage as stage from staged"),
    "retained_runs": with_ctes([RUNS], "select run_id, stage from runs where stage is not null"),
    "promoted_runs": with_ctes([RUNS, """
numbered as (
  select 'R' || (substring(run_id, 2)::int // 2) as run_id, 1 + substring(run_id, 2)::int % 2 as version, algorithm,
    stage, val_score, test_score from runs),
held as (
  select run_id, version, val_score, test_score, case when stage = 'production' or (stage is not null and place <= 10) then stage end as stage
  from (select *, row_number() over (partition by algorithm, coalesce(stage in ('development', 'staging'), false)
    order by val_score desc, run_id, version) as place from numbered))""", staged("held", 30)], """
select run_id, version::bigint as version, new_stage as stage from staged where new_stage is not null"""),
    "model_leaderboard": with_ctes(
        [RUNS, "board as (select run_id, stage, algorithm, "
         + ", ".join(f'"{m}" as {m}_raw, 100 * round_even("{m}", 3) as {m}_pct' for m in BOARD)
         + " from runs where stage is not null)"], f"""
select run_id, stage, algorithm, {pins([f"{m}_pct" for m in BOARD])},
  {", ".join(pin(f"round_even(round_even(100 * {m}_raw, 2) - (select avg({m}_pct) from board), 2)", f"{m}_gap") for m in BOARD)}
from board"""),
}

# -- models: keys, and that what is fitted keeps to its range ------------------------------------------------

SPLIT = FEATURED + [ranked(20240601, "features")]
_tested = with_ctes(SPLIT, f"""
select row_id, {KEYS}, target::bigint as target, 1::bigint as fits from ranked where rank <= 0.2::double * class_size""")
_every_feature = " union all ".join(f"select '{f}' as feature, 1::bigint as fits" for f in FEATURES)
_latest = f"""
select {KEYS}, {pin("step", "step")}, 1::bigint as fits
from (select *, row_number() over (partition by {KEYS} order by step desc, tie_rank, tie_name, row_id) as n from features)
where n = 1"""

SQL |= {
    "forest_predictions": _tested,
    "boosted_predictions": _tested,
    "stump_predictions": with_ctes(FEATURED, f"select row_id, {KEYS}, (exams_sum > 2)::int::bigint as predicted from features"),
    "fold_scores": "select unnest(range(0, 4))::bigint as fold, 1::bigint as fits",
    "searched_runs": """
select 'trial-' || n as draw, 1::bigint as version, 'evaluations' as search_end, 1::bigint as fits from range(0, 50) t(n)""",
    "updated_run": """
select 'forest-1' as run_id, 'random_forest' as algorithm, 2::bigint as version, 'development' as stage, 1::bigint as fits""",
    "forest_importance": _every_feature,
    "permuted_importance": _every_feature,
    "batch_scores": with_ctes(FEATURED, _latest),
    "champion_scores": with_ctes(FEATURED, f"""
select {KEYS}, case when (select count(distinct course_name) from activity) > 1 then 'all'
  else (select min(course_name) from activity) end as course_name,
  {pin("(select max(step) from activity)", "step")}, 1::bigint as fits
from (select distinct {KEYS} from features)"""),
}


def longs(name: str, *columns: str) -> None:
    """Give integer columns the type the engine gives them."""
    casts = ", ".join(f"cast({c} as bigint) as {c}" for c in columns)
    SQL[name] = f"select * replace ({casts}) from ({SQL[name]})"


longs("targets", "target", "has_final")
longs("exam_and_task_flags", *COUNTERS.values())
for _name in ("aligned_log", "aligned_submissions", "collapsed_exams", "cleaned_log", "cleaned_log_hot_groups", "ordered_log"):
    longs(_name, "tie_rank")
for _name in ("prefix_features", "prefix_features_hot_groups", "latest_rows"):
    longs(_name, "tie_rank", "target")
for _name in ("class_balance", "train_test_split", "fold_numbers", "oversampled", "undersampled", "smote_rows"):
    longs(_name, "target")
longs("submitted_creations", "points_n")
longs("predicted_class", "predicted")

# -- synthetic rows on all features, in whole thousandths --

_thousandths = ", ".join(f"floor({f} * 1000.0::double + 0.50003::double) as {f}" for f in FEATURES)
_gap = " + ".join(f"(x.{f} - y.{f}) * (x.{f} - y.{f})" for f in FEATURES)
DRAWN = FEATURED + [f"whole as (select row_id, target, {_thousandths} from features)", f"""
sizes as (
  select target as small, count(*) as have, max(count(*)) over () - count(*) as lack from whole group by target
  order by have, target limit 1),
minority as (
  select *, row_number() over (order by md5(row_id || ':0'), row_id) as rank, min(row_id) over (partition by {', '.join(FEATURES)}) as vid
  from whole where target = (select small from sizes)),
draws as (
  select row_id, vid, target, rank, unnest(range(1, (lack // have + case when rank <= lack % have then 1 else 0 end + 1)::bigint)) as turn
  from minority, sizes),
placed as (select *, (rank + turn) % 5 + 1 as number from draws)"""]

SQL |= {
    "smote_features": with_ctes(DRAWN + [f"""
met as (
  select x.row_id, y.vid as nid, x.vid <> y.vid as apart, {_gap} as gap, y.row_id as other
  from minority x join minority y on x.row_id <> y.row_id where x.row_id in (select row_id from draws)),
near as (select row_id, nid, row_number() over (partition by row_id order by apart, gap, nid, other) as number from met)"""], """
select row_id as base_id, turn, number, nid as neighbour_id, target::bigint as target from placed join near using (row_id, number)"""),
    "smote_graph_features": with_ctes(DRAWN, "select row_id as base_id, turn, number, target::bigint as target, 1::bigint as fits from placed"),
}

SQL["carried_features"] = SQL["prefix_features"]

# -- an export with bad numbers: lines are numbered in the order of events --

LINES = BASE + ["""
lines as (
  select * replace (row_number() over (order by row_id) - 1 as row_id), row_id % 31 = 0 and exam_grade is not null as bad_grade,
    row_id % 37 = 0 as bad_step from activity)"""]

SQL |= {
    "held_lines": with_ctes(LINES, """
select row_id, 'exam_grade' as column, 'seven' as text from lines where bad_grade
union all select row_id, 'step' as column, 'soon' as text from lines where bad_step"""),
    "released_rows": with_ctes(LINES, f"""
select row_id, {KEYS}, {pin("case when bad_step then 2 else step end", "step")},
  {pin("case when bad_grade then 7 else exam_grade end", "exam_grade")}, task_name, {pins(["sub_score"])} from lines"""),
}

# -- leaf-wise trees: one split, gradients half a unit a row, fails weighted double, rate 0.8, l1 0.25, l2 1.5 --

ONE_SPLIT = """
sides as (
  select count(*) filter (exams_sum <= 2) as low, count(*) filter (exams_sum > 2) as high from features),
leaves as (
  select low, high, -0.8 * greatest(0.5 * low - 0.25, 0) / (0.25 * low + 1.5) as low_value,
    0.8 * greatest(high - 0.25, 0) / (0.5 * high + 1.5) as high_value from sides),
split as (
  select low_value, high_value, (low * low_value + 2 * high * high_value) / (low + 2 * high) as expected from leaves),
margins as (
  select row_id, learner_id, course_id, case when exams_sum > 2 then high_value else low_value end as margin, expected
  from features, split)"""

SQL |= {
    "leafwise_probabilities": with_ctes(FEATURED + [ONE_SPLIT], f"select row_id, {KEYS}, {pin('1 / (1 + exp(-margin))', 'p')} from margins"),
    "leafwise_classes": with_ctes(FEATURED, f"select row_id, {KEYS}, (exams_sum > 2 and step > 100)::int::bigint as predicted from features"),
    "tree_attributions": with_ctes(FEATURED + [ONE_SPLIT], f"""
select row_id, {KEYS}, {pin('margin', 'margin')}, {pin('expected', 'expected')}, {pin('margin - expected', 'exams_sum')}, {pin('0', 'others')}
from margins"""),
    "attributed_importance": with_ctes(FEATURED + [ONE_SPLIT, "names(feature) as (values " + ", ".join(f"('{f}')" for f in FEATURES) + ")"], f"""
select row_number() over (order by feature <> 'exams_sum', feature) as place, feature,
  {pin("case when feature = 'exams_sum' then (select avg(abs(margin - expected)) from margins) else 0 end", "importance")},
  {pin("1", "running_share")} from names"""),
    "forest_attributions": with_ctes(SPLIT, f"""
select row_id, {KEYS}, 1::bigint as fits from ranked where rank <= 0.2::double * class_size"""),
    "models_in_one_pass": with_ctes(FEATURED, """
select 'past_' || n as run_id, count(*) filter (exams_sum > n and target = 1) as tp, count(*) filter (exams_sum > n and target = 0) as fp,
  count(*) filter (exams_sum <= n and target = 1) as fn, count(*) filter (exams_sum <= n and target = 0) as tn
from features, range(0, 3) t(n) group by n"""),
    "warm_started_runs": """
select * from (values ('first-0', 'random', 1::bigint), ('second-0', 'stored', 1::bigint), ('second-1', 'random', 1::bigint),
  ('second-2', 'model', 1::bigint)) t(draw, origin, fits)""",
}

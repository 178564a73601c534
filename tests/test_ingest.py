"""Lines that don't conform, and files that can be skipped."""

import pytest
from conftest import activity, row
from pyspark.sql import functions as F

from gradeloom.schema import EXPORT_COLUMNS
from gradeloom.sources.activity import ingest_export, read_activity, release, write_log

HEADER = ";".join(EXPORT_COLUMNS)


def line(**cells):
    return ";".join(str(cells.get(ours, "")) for ours in EXPORT_COLUMNS.values())


def test_every_line_is_kept_or_held(spark, tmp_path):
    lines = [
        line(learner_id="L1", step="1.5", exam_grade="7"), line(learner_id="L2", step="soon", exam_grade="x;y".replace(";", ",")),
        line(learner_id="L3", step="NA", exam_grade="N/A", sub_created_at="9.0"), "L4;C1", line(learner_id="L5") + ";one;two",
        line(learner_id='"L;6"', step="2"), line(learner_id="L7", task_due_at="9.5.1"), line(learner_id="L8", step="3"),
    ]
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines[:5]]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEADER, *lines[5:]]) + "\n")
    source, out, aside = str(tmp_path / "*.csv"), str(tmp_path / "log"), str(tmp_path / "held")
    kept = ingest_export(spark, source, out, held_path=aside)
    held = spark.read.parquet(aside)
    assert {r.row_id: (r.learner_id, r.step) for r in kept.collect()} == {0: ("L1", 1.5), 2: ("L3", None), 5: ("L;6", 2.0), 7: ("L8", 3.0)}
    got = {r.row_id: r for r in held.collect()}
    assert sorted(got) == [1, 3, 4, 6] and kept.count() + held.count() == len(lines)
    assert got[1].faults == [("exam_grade", "x,y"), ("step", "soon")] or got[1].faults == [("step", "soon"), ("exam_grade", "x,y")]
    assert got[3].record == lines[3] and got[4].record == lines[4] and got[6].faults == [("task_due_at", "9.5.1")]
    assert got[1].file.endswith("a.csv") and got[6].file.endswith("b.csv")
    # put right, they go back to their places; what is still wrong is held again
    fixed = held.withColumn("record", F.when(F.col("row_id") == 3, line(learner_id="L4", course_id="C1"))
                            .otherwise(F.regexp_replace(F.regexp_replace("record", "soon", "4"), "x,y", "")))
    rows, still = release(fixed)
    assert {r.row_id: (r.learner_id, r.course_id, r.step) for r in rows.collect()} == {1: ("L2", None, 4.0), 3: ("L4", "C1", None)}
    assert sorted(r.row_id for r in still.collect()) == [4, 6]


def test_nothing_held_and_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + line(learner_id="L1") + "\n")
    assert ingest_export(spark, str(tmp_path / "a.csv"), str(tmp_path / "x"), held_path=str(tmp_path / "y")).count() == 1
    assert spark.read.parquet(str(tmp_path / "y")).count() == 0
    (tmp_path / "b.csv").write_text(HEADER + "\n")
    assert ingest_export(spark, str(tmp_path / "b.csv"), str(tmp_path / "v"), held_path=str(tmp_path / "w")).count() == 0


def scanned(df):
    """Rows that the scan of a collected table handed on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Two hundred thousand events of four thousand learners and ten courses, in row groups of some thousand rows."""
    path = str(tmp_path_factory.mktemp("log"))
    first = activity(spark, [row(0)])
    events = spark.range(200_000).select(
        F.col("id").alias("row_id"), F.concat(F.lit("L"), F.md5((F.col("id") * 7919 % 4000).cast("string"))).alias("learner_id"),
        F.concat(F.lit("course "), (F.col("id") * 31 % 10).cast("string")).alias("course_name"), (F.col("id") % 60).cast("double").alias("step"))
    spark.conf.set("parquet.page.row.count.limit", "500")
    write_log(first.unionByName(events, allowMissingColumns=True), path, row_group_bytes=64 * 1024, files=8)
    return path


def test_a_learner_filter_opens_few_row_groups(spark, log):
    own = "L" + __import__("hashlib").md5(b"77").hexdigest()
    rows = read_activity(spark, log, learner_ids=[own]).select("row_id")
    want = {i for i in range(200_000) if i * 7919 % 4000 == 77}
    assert {r.row_id for r in rows.collect()} == want
    assert scanned(rows) < 200_000 * 0.2
    # one that isn't there, though it lies between others: the Bloom filters rule out every row group
    absent = read_activity(spark, log, learner_ids=["L8" + "0" * 31]).select("row_id")
    assert absent.count() == 0 and scanned(absent) == 0


def test_course_and_course_with_learner(spark, log):
    course = read_activity(spark, log, course_name="course 3").select("row_id")
    assert 20_000 <= scanned(course) < 40_000
    own = "L" + __import__("hashlib").md5(b"77").hexdigest()
    both = read_activity(spark, log, course_name="course 7", learner_ids=[own]).select("row_id")
    assert scanned(both) < 10_000 and both.count() == len([i for i in range(200_000) if i * 7919 % 4000 == 77 and i * 31 % 10 == 7])


def test_the_layout_drops_nothing(spark, tmp_path, log):
    assert read_activity(spark, log).count() == 200_001
    frame = activity(spark, [row(i, learner=None if i % 3 else "L", course_name=None, step=None) for i in range(20)])
    write_log(frame, str(tmp_path / "x"))
    assert sorted(r.row_id for r in read_activity(spark, str(tmp_path / "x")).collect()) == list(range(20))
    write_log(frame.select("row_id", "step"), str(tmp_path / "y"))
    assert spark.read.parquet(str(tmp_path / "y")).count() == 20

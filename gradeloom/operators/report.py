"""Tables around predictions: summaries, verdicts, shares, options, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gradeloom.functions.scalars import percent, verdict
from gradeloom.operators.collapse import order_key
from gradeloom.schema import ACTIVITY


def learner_summary(clean: DataFrame) -> DataFrame:
    """Per learner: number and course of the first row, mean exam grade and mean score."""
    place = F.struct("course_id", *order_key())
    return clean.groupBy("learner_id").agg(
        F.min_by("learner_no", place).alias("learner_no"),
        F.min_by("course_name", place).alias("course_name"),
        # nine decimals first: the order of summation must not decide a half
        F.bround(F.round(F.avg("exam_grade"), 9), 1).alias("mean_grade"),
        F.bround(F.round(F.avg("sub_score"), 9), 1).alias("mean_score"),
    )


def verdicts(predictions: DataFrame, cutoff: float) -> DataFrame:
    """Predictions as percent and Pass/Fail; rows without a probability are left out."""
    return predictions.where(F.col("p").isNotNull()).withColumn("fail_pct", percent("p")).withColumn(
        "verdict", verdict("fail_pct", cutoff)
    )


def prediction_report(predictions: DataFrame, summary: DataFrame, cutoff: float) -> DataFrame:
    """Verdicts with each learner's summary, most likely to fail first."""
    joined = verdicts(predictions, cutoff).join(summary, "learner_id", "left")
    return joined.orderBy(F.desc("p"), "learner_id", "course_id")


def verdict_shares(report: DataFrame) -> DataFrame:
    """Percent of passes and fails; an absent class is 0."""
    shares = [
        (100.0 * F.avg(F.when(F.col("verdict") == v, 1.0).otherwise(0.0))).alias(f"{v.lower()}_pct")
        for v in ("Pass", "Fail")
    ]
    return report.agg(*shares)


def options(df: DataFrame, column: str) -> DataFrame:
    """Values of a column, the most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), column)


def prediction_folders(predictions: DataFrame, activity: DataFrame, step: float | None = None) -> DataFrame:
    """Predictions with the folder columns of their sink: course (or 'all') and step (or the last)."""
    facts = activity.agg(
        F.when(F.countDistinct("course_name") > 1, "all").otherwise(F.min("course_name")).alias("course"),
        F.max("step").alias("last"),
    )
    last = F.lit(step) if step is not None else facts.select("last").scalar()
    return predictions.withColumns({"course_name": facts.select("course").scalar(), "step": last})


def to_requests(activity: DataFrame) -> DataFrame:
    """One JSON text per activity row."""
    return activity.select("row_id", F.to_json(F.struct(*ACTIVITY.names)).alias("body"))


def from_requests(requests: DataFrame) -> DataFrame:
    """Activity rows out of JSON texts, with the declared schema."""
    return requests.select(F.from_json("body", ACTIVITY).alias("row")).select("row.*")


def to_responses(predictions: DataFrame) -> DataFrame:
    """One JSON text per learner and course: a probability must not lose its course."""
    return predictions.select(
        "learner_id", "course_id", F.to_json(F.struct("learner_id", "course_id", "p")).alias("body")
    )

"""Scores of a classifier from a table of (target, p), for one model or for each value of `by`."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from gradeloom.functions.scalars import ratio
from gradeloom.operators.blocks import before_block, range_blocks

SWEEP = range(30, 61)  # fixed values: cutoffs in percent


def predicted(p: str, cutoff: Column | float) -> Column:
    """Class 1 strictly above the cutoff."""
    return F.when(F.col(p) > cutoff, 1).otherwise(0)


def confusion(scored: DataFrame, cutoff: float = 0.5, by: list[str] = []) -> DataFrame:
    """tp, fp, fn, tn in one pass."""
    hit, fail = predicted("p", cutoff) == 1, F.col("target") == 1
    return scored.groupBy(*by).agg(
        F.count_if(hit & fail).alias("tp"),
        F.count_if(hit & ~fail).alias("fp"),
        F.count_if(~hit & fail).alias("fn"),
        F.count_if(~hit & ~fail).alias("tn"),
    )


def quality(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy from confusion counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
    })


def score_steps(scored: DataFrame, by: list[str] = [], blocks: int | None = None) -> DataFrame:
    """Per distinct score from high to low: positives and negatives at and above it.

    Equal scores are counted together first; what is left is distinct and is summed in blocks, as a
    model may give nearly every row a score of its own.
    """
    counts = scored.groupBy(*by, "p").agg(
        F.count_if(F.col("target") == 1).alias("pos"),
        F.count_if(F.col("target") == 0).alias("neg"),
    )
    down = F.col("p").desc()
    cut = range_blocks(counts, by, [down], blocks)
    totals = cut.groupBy(*by, "block").agg(F.sum("pos").alias("pos_here"), F.sum("neg").alias("neg_here"))
    earlier = before_block(
        totals, by, {"pos_before": "sum(pos_here)", "neg_before": "sum(neg_here)"}
    )
    ends = totals.groupBy(*by).agg(F.sum("pos_here").alias("positives"), F.sum("neg_here").alias("negatives"))
    offsets = earlier.join(ends, by) if by else earlier.withColumns(
        {c: ends.select(c).scalar() for c in ("positives", "negatives")}
    )
    inside = Window.partitionBy(*by, "block").orderBy(down).rowsBetween(Window.unboundedPreceding, 0)
    run = cut.withColumns({"pos_run": F.sum("pos").over(inside), "neg_run": F.sum("neg").over(inside)})
    run = run.join(offsets, [*by, "block"])
    return run.select(
        *by, "p", "pos", "neg",
        (F.col("pos_run") + F.coalesce("pos_before", F.lit(0))).alias("tp"),
        (F.col("neg_run") + F.coalesce("neg_before", F.lit(0))).alias("fp"),
        "positives", "negatives",
    )


def roc_points(scored: DataFrame, by: list[str] = [], blocks: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, with the point (0, 0) at threshold infinity."""
    steps = score_steps(scored, by, blocks)
    points = steps.select(
        *by, F.col("p").alias("threshold"),
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    start = steps.select(*by).distinct() if by else steps.limit(1)
    start = start.select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def auc(scored: DataFrame, by: list[str] = [], blocks: int | None = None) -> DataFrame:
    """Area under the ROC curve; null where a class is missing."""
    steps = score_steps(scored, by, blocks)
    slab = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    area = F.try_divide(F.sum(slab), F.max(F.col("positives").cast("double") * F.col("negatives")))
    return steps.groupBy(*by).agg(area.alias("roc_auc"))


def area_under(points: DataFrame, by: list[str] = [], blocks: int | None = None) -> DataFrame:
    """Trapezoid area under given ROC points (fpr, tpr).

    Each block takes the last point of the block before it along, so no task sees a whole curve.
    """
    cut = range_blocks(points.select(*by, "fpr", "tpr"), by, [F.col("fpr"), F.col("tpr")], blocks)
    ends = cut.groupBy(*by, "block").agg(F.expr("max(struct(fpr, tpr)) as last"))
    carried = before_block(ends, by, {"carry": "max(last)"})
    along = f"(partition by {', '.join([*by, 'block'])} order by fpr, tpr)"
    last = F.coalesce(F.expr(f"lag(struct(fpr, tpr)) over {along}"), F.col("carry"))
    steps = cut.join(carried, [*by, "block"]).withColumn("last", last)
    slab = "sum((fpr - last.fpr) * (tpr + last.tpr) / 2.0D) as area"
    return steps.groupBy(*by).agg(F.expr(slab))


def hard_auc(counts: DataFrame) -> DataFrame:
    """AUC of the hard classes: the mean of true positive and true negative rate."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumn("hard_auc", (ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2.0)


def cutoff_sweep(scored: DataFrame, by: list[str] = [], percents=SWEEP) -> DataFrame:
    """Confusion counts and quality at every cutoff.

    Rows are first counted by how many cutoffs they exceed; only those few counts meet the cutoffs.
    """
    cutoffs = [c / 100.0 for c in percents]
    exceeded = reduce(add, [F.when(F.col("p") > c, 1).otherwise(0) for c in cutoffs])
    counts = scored.groupBy(*by, exceeded.alias("exceeded")).agg(
        F.count_if(F.col("target") == 1).alias("pos"),
        F.count_if(F.col("target") == 0).alias("neg"),
    )
    steps = F.posexplode(F.array(*[F.lit(c) for c in cutoffs])).alias("place", "cutoff")
    spread = counts.select(*by, "exceeded", "pos", "neg", steps)
    hit = F.col("place") < F.col("exceeded")
    swept = spread.groupBy(*by, "cutoff").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
    )
    return quality(swept)


def best_cutoff(scored: DataFrame, by: list[str] = [], percents=SWEEP) -> DataFrame:
    """The cutoff of the best F1, the lowest on a tie."""
    best = F.max_by(F.struct("cutoff", "f1"), F.struct("f1", -F.col("cutoff")))
    return cutoff_sweep(scored, by, percents).groupBy(*by).agg(best.alias("best")).select(*by, "best.*")


def evaluation(scored: DataFrame, cutoff: float = 0.5, by: list[str] = []) -> DataFrame:
    """Confusion counts, quality and AUC together, one row for each value of `by`."""
    counts = quality(confusion(scored, cutoff, by))
    areas = auc(scored, by)
    if by:
        return counts.join(areas, by)
    return counts.withColumn("roc_auc", areas.scalar())


METRICS = {
    "f1_score": "f1", "precision": "precision", "recall": "recall",
    "roc_auc": "roc_auc", "accuracy": "accuracy",
}


def with_main_score(evaluated: DataFrame, metric: str) -> DataFrame:
    """Add `test_score`, the metric that models compete on."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, have {sorted(METRICS)}")
    return evaluated.withColumn("test_score", F.col(METRICS[metric]))


def mean_magnitude(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance): mean absolute value of each column, in one pass.

    Rounded to nine decimals, so that the order in which rows are summed cannot break a tie.
    """
    means = df.agg(*[F.round(F.avg(F.abs(c)), 9).alias(c) for c in features])
    pair = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in features
    ]))
    return means.select(pair.alias("pair")).select("pair.*")


def ranked_importance(importance: DataFrame, top: int | None = None) -> DataFrame:
    """Features by importance with the running share; a table as long as the feature list."""
    order = Window.orderBy(F.desc("importance"), "feature")
    share = F.sum("importance").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = importance.select(
        F.row_number().over(order).alias("place"), "feature", "importance",
        ratio(share, F.sum("importance").over(Window.partitionBy())).alias("running_share"),
    )
    return ranked if top is None else ranked.orderBy("place").limit(top)

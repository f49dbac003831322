"""Ranking metrics of a binary score, for any number of groups in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Ranges of the score axis that are ranked on their own, and the accuracy of the quantiles that cut them.
RANGES = 1024
ACCURACY = 10_000


def auc(df: DataFrame, by: str, score: str, label: str = "label", ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve; ties count half, NULL for a single class.

    Rows first collapse to one row per distinct score, so ties cost nothing.
    Ranking all scores of a group would be one task per group: the scores are
    cut into ranges at approximate quantiles of the distinct scores, so that one
    score of most rows does not fill a range; each range is ranked on its own,
    and a range beats all negatives of the ranges below it. The cuts only
    balance the work; they do not change the result.
    Rows without a score are left out. ``by`` names a handful of groups, such as
    the splits: their cuts are broadcast.
    """
    ranges = RANGES if ranges is None else ranges
    if ranges < 2:
        raise ValueError("the score axis needs at least two ranges")
    value = F.col(score).cast("double")
    rows = df.where(value.isNotNull() & ~F.isnan(value)).select(
        by, value.alias("score"), F.col(label).alias("label")
    )
    scores = rows.groupBy(by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    cuts = score_cuts(scores, by, ranges)
    # One row of at most ``ranges`` numbers per group.
    ranged = scores.join(F.broadcast(cuts), by).select(
        by, "score", "pos", "neg",
        _cuts_below(ranges).alias("range"),
    )
    lower_scores = Window.partitionBy(by, "range").orderBy("score")
    by_range = (
        ranged.withColumn("below", _sum_before("neg", lower_scores))
        .groupBy(by, "range")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            # Twice the negatives each positive beats inside the range, as whole numbers.
            F.sum(_whole("pos") * _whole(2 * F.col("below") + F.col("neg"))).alias("won"),
        )
    )
    lower_ranges = Window.partitionBy(by).orderBy("range")
    totals = (
        by_range.withColumn("below", _sum_before("neg", lower_ranges))
        .groupBy(by)
        .agg(
            F.sum(F.col("won") + _whole("pos") * _whole(2 * F.col("below")))
            .cast("double").alias("won"),
            F.sum("pos").cast("double").alias("pos"),
            F.sum("neg").cast("double").alias("neg"),
        )
    )
    return totals.select(
        by, F.try_divide(F.col("won"), 2 * F.col("pos") * F.col("neg")).alias("auc")
    )


def score_cuts(scores: DataFrame, by: str, ranges: int) -> DataFrame:
    """Per group, the upper ends of all ranges but the last; ``scores`` has a row for each distinct score."""
    steps = [i / ranges for i in range(1, ranges)]
    return scores.groupBy(by).agg(F.percentile_approx("score", steps, ACCURACY).alias("cuts"))


def _cuts_below(ranges: int) -> Column:
    """How many of the sorted ``cuts`` are less than ``score``: a binary search, a step for each digit of the number of cuts."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(ranges.bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda below, step: F.when(
        (below + step <= F.size("cuts")) & (F.get("cuts", below + step - 1) < F.col("score")), below + step
    ).otherwise(below))


def hard_auc(df: DataFrame, by: str, prediction: str, label: str = "label") -> DataFrame:
    """Area under the ROC curve of 0/1 predictions: the mean of both class recalls."""
    hit = F.col(prediction) == F.col(label)
    recalls = [
        F.try_divide(F.count_if(hit & (F.col(label) == c)), F.count_if(F.col(label) == c))
        for c in (1, 0)
    ]
    return df.groupBy(by).agg(((recalls[0] + recalls[1]) / 2).alias("auc"))


def gini(auc_column: Column) -> Column:
    """2 AUC - 1, rounded half to even to three digits."""
    return F.bround(2 * auc_column - 1, 3)


def _sum_before(name: str, window: WindowSpec) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(earlier), F.lit(0))


def _whole(value: Column | str) -> Column:
    """Wide enough for the product of two row counts."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("decimal(19,0)")

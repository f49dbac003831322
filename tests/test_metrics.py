import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from arrears.operators import metrics


def brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg)) if pos and neg else None


def frame(spark, groups):
    data = [(g, float(s), y) for g, pairs in groups.items() for s, y in pairs]
    return spark.createDataFrame(data, "split string, score double, label int").repartition(5)


def test_one_score_of_nearly_all_rows_fills_no_range(spark):
    pairs = [(0, i % 2) for i in range(40_000)] + [(i, i % 3 == 0) for i in range(1, 801)]
    scores = frame(spark, {"g": [(s, int(y)) for s, y in pairs]}).groupBy("split", "score").count()
    cuts = sorted(set(metrics.score_cuts(scores, "split", 64).first().cuts))
    filled = [0] * (len(cuts) + 1)
    for score in range(801):
        filled[sum(cut < score for cut in cuts)] += 1
    assert max(filled) <= 4 * 801 / 64


def auc_of(df, **options):
    return {r.split: r.auc for r in metrics.auc(df, "split", "score", **options).collect()}


@pytest.mark.parametrize("ranges", [2, 5, 256])
def test_auc_equals_all_pairs(spark, ranges):
    rng = random.Random(3)
    groups = {
        "fine": [(rng.random(), rng.randrange(2)) for _ in range(300)],
        "ties": [(rng.randrange(6), rng.randrange(2)) for _ in range(300)],
        "hot": [(5, rng.randrange(2)) for _ in range(200)] + [(i, i % 2) for i in range(100)],
        "one score": [(7, i % 2) for i in range(20)],
        "one class": [(i, 1) for i in range(20)],
        "perfect": [(i, int(i > 10)) for i in range(20)],
        "negative": [(rng.gauss(0, 1), rng.randrange(2)) for _ in range(100)],
    }
    got = auc_of(frame(spark, groups), ranges=ranges)
    for name, pairs in groups.items():
        want = brute(pairs)
        assert got[name] == (want if want is None else pytest.approx(want, abs=1e-12)), name
    assert got["one score"] == 0.5 and got["one class"] is None and got["perfect"] == 1.0


def test_auc_equals_the_evaluator(spark):
    df = spark.range(4000).selectExpr(
        "'s' AS split", "rand(5) AS score", "cast(rand(6) < 0.3 AS double) AS label"
    )
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert auc_of(df)["s"] == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_auc_survives_increasing_transforms_and_skips_missing(spark):
    df = frame(spark, {"s": [((i * 37) % 101, int(i % 3 == 0)) for i in range(400)]})
    want = auc_of(df)
    assert auc_of(df.withColumn("score", F.exp(F.col("score") / 50))) == want
    extra = df.withColumn("score", F.lit(None).cast("double")).unionByName(
        df.withColumn("score", F.lit(float("nan"))))
    assert auc_of(df.unionByName(extra)) == want


def test_hard_auc_is_the_mean_recall(spark):
    df = spark.createDataFrame(
        [("s", 1, 1), ("s", 1, 0), ("s", 0, 0), ("s", 0, 0), ("s", 0, 1), ("t", 1, 1)],
        "split string, label int, prediction int",
    )
    got = {r.split: r.auc for r in metrics.hard_auc(df, "split", "prediction").collect()}
    assert got["s"] == pytest.approx((1 / 2 + 2 / 3) / 2) and got["t"] is None


def test_gini_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.75,), (0.53125,), (None,)], "auc double")
    assert [r.g for r in df.select(metrics.gini(F.col("auc")).alias("g")).collect()] == [0.5, 0.062, None]

"""The split against a plain ranking, on ordinary and on hot classes and keys."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arrears.operators import split
from arrears.operators.split import class_sizes, stratified_split
from arrears.sources.tables import ROW_ID, read_numbered


def frame(spark, data):
    df = spark.createDataFrame(data, "loan_id string, label int, fe_1 double")
    return df.withColumn("segment", F.lit("train_test"))


def train_sizes(counts, ratio=0.8):
    """The rule in plain Python: test rounded up, train shared by largest fraction."""
    total = sum(counts.values())
    n_train = total - math.ceil((1 - ratio) * total)
    shares = {c: n / total * n_train for c, n in counts.items()}
    sizes = {c: math.floor(s) for c, s in shares.items()}
    by_fraction = sorted(counts, key=lambda c: (sizes[c] - shares[c], c))
    for c in by_fraction[: n_train - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


@pytest.mark.parametrize("counts", [
    {0: 10, 1: 5}, {0: 7, 1: 7}, {0: 999, 1: 1}, {0: 3, 1: 2, 2: 2}, {0: 1}, {0: 2220, 1: 626},
])
def test_class_sizes(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "label int, n bigint")
    got = {row.label: row.n_train for row in class_sizes(df).collect()}
    assert got == train_sizes(counts)


def expected_train(data, ratio=0.8, seed=88):
    sizes = train_sizes(Counter(label for _, label, _ in data), ratio)
    train = Counter()
    for label, size in sizes.items():
        ranked = sorted(
            (hashlib.md5(f"{key}|{seed}".encode()).hexdigest(), key)
            for key, value, _ in data if value == label
        )
        train.update(key for _, key in ranked[:size])
    return train


@pytest.mark.parametrize("prefix", [0, 1, 4])
def test_equals_plain_ranking(spark, monkeypatch, prefix):
    monkeypatch.setattr(split, "_PREFIX", prefix)
    data = [(str(i), int(i % 7 < 2), float(i)) for i in range(1500)]
    got = stratified_split(frame(spark, data)).where("split = 'train'")
    assert Counter(row.loan_id for row in got.collect()) == expected_train(data)


@pytest.mark.parametrize("hot, folds", [(700, 1), (15000, 1), (15000, 3)])
def test_a_loan_with_many_of_the_rows_is_cut_exactly(spark, hot, folds):
    data = [("hot", 0, float(i)) for i in range(hot)]
    data += [(str(i), int(i % 4 == 0), 0.0) for i in range(1300)]
    out = stratified_split(frame(spark, data), folds=folds).cache()
    sizes = train_sizes(Counter(label for _, label, _ in data))
    got = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert {c: got[c, "train"] for c in sizes} == sizes
    assert out.count() == len(data)
    folded = out.where("split = 'train'").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        parts = [row["count"] for row in folded if row.label == label]
        assert len(parts) == folds and max(parts) - min(parts) <= 1
    cold = [row.loan_id for row in out.where("split = 'train' AND loan_id <> 'hot'").collect()]
    assert Counter(cold) == Counter({k: 1 for k in expected_train(data) if k != "hot"})


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("folds", [1, 3])
def test_equal_rows_are_cut_exactly(spark, tmp_path, partitions, folds):
    data = [("same", 0, 1.0)] * 900 + [(str(i), 0, 0.0) for i in range(100)]
    frame(spark, data).repartition(partitions).write.parquet(str(tmp_path / "t"))
    table = read_numbered(spark, str(tmp_path / "t"))
    out = stratified_split(table, folds=folds, row_id=ROW_ID).cache()
    assert out.columns == ["loan_id", "label", "fe_1", "segment", "split", "fold"]
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 800, "test": 200}
    parts = [r["count"] for r in out.where("split = 'train'").groupBy("fold").count().collect()]
    assert len(parts) == folds and max(parts) - min(parts) <= 1
    cold = out.where("split = 'train' AND loan_id <> 'same'")
    assert Counter(r.loan_id for r in cold.collect()) == Counter({k: 1 for k in expected_train(data) if k != "same"})


def test_equal_rows_stay_together_without_a_row_id(spark):
    data = [("same", 0, 1.0)] * 300 + [(str(i), 0, 0.0) for i in range(600)]
    out = stratified_split(frame(spark, data))
    assert out.where("loan_id = 'same'").select("split").distinct().count() == 1
    assert out.count() == 900


def test_folds_are_equal_complete_and_nested_in_train(spark):
    data = [(str(i), int(i % 5 == 0), 0.0) for i in range(1003)]
    df = frame(spark, data).withColumn(
        "segment", F.when(F.col("loan_id").cast("int") < 900, "train_test").otherwise("oot")
    )
    out = stratified_split(df, folds=3).cache()
    plain = stratified_split(df).select("loan_id", "split")
    assert out.select("loan_id", "split").exceptAll(plain).count() == 0
    assert out.where("split = 'oot'").count() == 103
    assert out.where("(split = 'train') <> (fold IS NOT NULL)").count() == 0
    for label in (0, 1):
        sizes = [
            r["count"] for r in
            out.where(f"split = 'train' AND label = {label}").groupBy("fold").count().collect()
        ]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_tiny_class_goes_to_test(spark):
    data = [(str(i), 0, 0.0) for i in range(50)] + [("x", 1, 0.0)]
    out = stratified_split(frame(spark, data), folds=3)
    assert out.where("label = 1").first().split == "test" or train_sizes({0: 50, 1: 1})[1] == 1
    assert out.where("split IS NULL").count() == 0


def test_placing_rows_needs_no_shuffle(spark):
    out = stratified_split(frame(spark, [(str(i), i % 2, 0.0) for i in range(100)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_numbers_and_missing_keys_are_placed_too(spark):
    df = spark.range(100).selectExpr(
        "if(id < 30, NULL, id) AS loan_id", "0 AS label", "cast(id AS double) AS fe_1",
        "'train_test' AS segment",
    )
    sizes = {r.split: r["count"] for r in stratified_split(df).groupBy("split").count().collect()}
    assert sizes == {"train": 80, "test": 20}


def test_split_does_not_depend_on_partitions(spark):
    df = frame(spark, [(str(i % 400), int(i % 3 == 0), float(i)) for i in range(1200)])
    columns = ["loan_id", "label", "fe_1", "split", "fold"]
    a = stratified_split(df.repartition(1), folds=3).select(columns)
    b = stratified_split(df.repartition(7, "fe_1"), folds=3).select(columns)
    assert a.exceptAll(b).count() == 0

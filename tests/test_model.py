"""Training, registry and scoring on the derived loan book."""

import math
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from arrears.__main__ import parser
from arrears.operators import model
from arrears.operators.scaling import Scaler
from arrears.operators.split import stratified_split
from arrears.operators.training_set import in_window, join_features, segment, training_matrix
from arrears.plans import registry, scoring, training
from arrears.sources.tables import read_features
from catalogue.fixtures import MONTHS, POINT
from catalogue.queries import VERSION
from catalogue.store import store

SMALL = {"n_estimators": [2, 3], "max_depth": [2], "reg_alpha": [0, 1]}


@pytest.fixture(scope="module")
def mart(spark, sf_dir):
    mart = store(spark, sf_dir)
    assert mart.run
    return mart


def test_candidates_are_drawn_without_repeats():
    drawn = model.draw_candidates()
    assert len(drawn) == 100 == len({tuple(c.items()) for c in drawn})
    assert drawn == model.draw_candidates() != model.draw_candidates(seed=1)
    assert len(model.draw_candidates(5000)) == 1728 == math.prod(map(len, model.SEARCH_SPACE.values()))


def test_candidates_map_to_spark_parameters(spark):
    settings = {tuple(model.spark_params(c, 1000).items()) for c in model.draw_candidates(5000)}
    assert len(settings) == 192
    params = model.spark_params({"gamma": 0.1, "min_child_weight": 3}, 1000)
    assert params == {"minInfoGain": 0.1 / 1000, "minInstancesPerNode": 12}
    gbt = model.classifier(model.draw_candidates(1)[0], 1000)
    assert gbt.getSeed() == 88 and gbt.getFeatureSubsetStrategy() in ("0.6", "0.8")


def test_a_gamma_of_the_space_leaves_splits(spark, mart):
    train = mart.run.training_set.where("split = 'train'")
    matrix = train.select(F.col("label").cast("double").alias("label"), *mart.run.scaler.mean)
    for stage in model.preparation(mart.run.scaler):
        matrix = stage.transform(matrix)
    candidate = {"n_estimators": 5, "max_depth": 3, "gamma": 0.1, "min_child_weight": 1}
    trees = model.classifier(candidate, train.count()).fit(matrix).trees
    assert all(tree.numNodes > 1 for tree in trees)


def test_combinations_are_numbered_in_order():
    space = {"a": [1, 2], "b": [3, 4, 5]}
    got = [tuple(model.combination(space, i).values()) for i in range(6)]
    assert got == [(1, 3), (1, 4), (1, 5), (2, 3), (2, 4), (2, 5)]


def test_stored_predictions_have_the_reported_auc(spark, mart):
    path = training.training_path(mart.bank, training.TrainingCalendar.of("1999-09-01"))
    found = duckdb.sql(f"""
        WITH s AS (SELECT split, score, sum(label) AS pos, sum(1 - label) AS neg
                   FROM '{path}/scored/*.parquet' GROUP BY ALL),
        b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beaten FROM s)
        SELECT split, sum(pos * (2 * beaten + neg)) / (2.0 * sum(pos) * sum(neg)) FROM b GROUP BY split""").fetchall()
    report = {r.split: r.auc for r in mart.run.report.collect()}
    assert {split: pytest.approx(auc, abs=1e-12) for split, auc in found} == report


def test_preparation_handles_missing_values(spark):
    df = spark.createDataFrame(
        [(1.0, None), (3.0, None), (None, None), (float("nan"), 1.0)], "fe_1 double, fe_2 double"
    )
    scaler = Scaler.fit(df.where("fe_2 IS NULL"), ["fe_1", "fe_2"])
    for stage in model.preparation(scaler):
        df = stage.transform(df)
    got = sorted(tuple(row.features.toArray()) for row in df.collect())
    assert got == [(-1.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 1.0, 1.0), (1.0, 0.0, 0.0, 1.0)]


def test_column_names_may_hold_dots(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "Customer_ID,snapshot_date,fe_a.b,home.city\n1,2023-01-01,1.5,x\n2,2023-01-01,,y\n"
    )
    features = read_features(spark, str(tmp_path / "f.csv"))
    assert features.columns == ["Customer_ID", "snapshot_date", "fe_a.b", "home.city"]
    labels = features.selectExpr(
        "Customer_ID AS loan_id", "Customer_ID", "0 AS label", "'x' AS label_def", "snapshot_date")
    rows = join_features(labels, features).withColumn("segment", F.lit("train_test"))
    split = stratified_split(rows)
    scaler = Scaler.fit(split, ["fe_a.b"])
    matrix = training_matrix(split, "loan_id")
    for stage in model.preparation(scaler):
        matrix = stage.transform(matrix)
    vectors = sorted(tuple(row.features.toArray()) for row in matrix.collect())
    assert vectors == [(0.0, 0.0), (0.0, 1.0)]
    assert model.input_names(scaler) == ["fe_a.b", "fe_a.b missing"]


def test_search_reports_every_candidate_once_and_picks_the_best(spark, mart):
    table = training.search_table(spark, mart.run.search).collect()
    assert [row.candidate for row in table] == list(range(len(table)))
    best = [row for row in table if row.is_best]
    assert len(best) == 1 and best[0].cv_auc_hard == max(row.cv_auc_hard for row in table)


def test_search_fits_settings_spark_cannot_tell_apart_once(spark, mart, monkeypatch):
    rows = mart.run.training_set.where("split = 'train'")
    matrix = training_matrix(rows, "fold")
    for stage in model.preparation(mart.run.scaler):
        matrix = stage.transform(matrix)
    fitted = []
    plain = model.classifier
    monkeypatch.setattr(model, "classifier", lambda c, *rest: fitted.append(c) or plain(c, *rest))
    found = model.random_search(matrix.cache(), model.draw_candidates(4, SMALL))
    assert len(found.scores) == 4 and len(fitted) == 2 * 3 + 1
    assert all(0 <= score <= 1 for score in found.scores)
    matrix.unpersist()


def test_report(mart):
    report = {row.split: row for row in mart.run.report.collect()}
    assert set(report) == {"train", "test", "oot"}
    for row in report.values():
        assert 0.5 < row.auc <= 1 and row.gini == pytest.approx(2 * row.auc - 1, abs=5.1e-4)
    assert sum(row.n for row in report.values()) == mart.run.training_set.count()


def test_registry_row(spark, mart):
    row = registry.registry(spark, mart.bank).first()
    report = {r.split: r for r in mart.run.report.collect()}
    assert row.model_version == VERSION == "credit_model_1999_09_01"
    assert row.features == [f"fe_{i}" for i in range(1, 8)]
    assert row.data_dates.oot_start == date(1999, 7, 1) and row.data_dates.train_test_ratio == 0.8
    assert row.results.auc_oot == report["oot"].auc and row.data_stats.n_train == report["train"].n
    assert set(row.hp_params) == set(model.SEARCH_SPACE)
    assert row.applied_params == row.hp_params


def test_registering_again_replaces_the_row(spark, mart, tmp_path):
    run, bank = mart.run, str(tmp_path)
    report = run.report.collect()
    cal = training.TrainingCalendar.of("1999-09-01")
    for version in (VERSION, "credit_model_other", VERSION):
        registry.register(spark, bank, version, run.pipeline, cal, 0.8, run.scaler, report, {"a": 1}, {})
    assert sorted(r.model_version for r in registry.registry(spark, bank).collect()) == [
        VERSION, "credit_model_other"]
    with pytest.raises(LookupError):
        registry.load_model(spark, bank, "credit_model_none")


def test_reloaded_model_gives_equal_scores(spark, mart):
    check = training.reload_check(spark, mart.bank, mart.run).first()
    assert check.equal and check.auc_before == mart.run.report.where("split = 'oot'").first().auc


def test_scoring_gives_one_prediction_per_feature_row(spark, sf_dir, mart):
    name = VERSION + ".pkl"
    out = scoring.score(spark, mart.features, mart.bank, name, mart.folder("p"), MONTHS)
    assert out.columns == ["Customer_ID", "snapshot_date", "model_name", "model_predictions"]
    assert out.count() == mart.features.count()
    assert out.where("model_predictions IS NULL OR NOT model_predictions BETWEEN 0 AND 1").count() == 0
    assert [r[0] for r in out.select("model_name").distinct().collect()] == [name]

    one = scoring.score(spark, mart.features, mart.bank, name, mart.folder("p"), [POINT])
    again = scoring.read_predictions(spark, mart.folder("p"), VERSION)
    assert 0 < one.count() < again.count() == mart.features.count()


def test_scoring_selects_features_by_name(spark, mart):
    shuffled = mart.features.select("fe_9" if "fe_9" in mart.features.columns else "fe_7", "Customer_ID",
                                    *[f"fe_{i}" for i in range(6, 0, -1)], "snapshot_date")
    names = list(mart.run.scaler.mean)
    args = (mart.run.pipeline, names, "m", [POINT])
    a = scoring.score_rows(mart.features, *args)
    b = scoring.score_rows(shuffled.withColumn("fe_99", F.lit(1.0)), *args)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_scoring_is_one_narrow_stage(mart):
    plan = scoring.score_rows(mart.features, mart.run.pipeline, list(mart.run.scaler.mean), "m", MONTHS)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_oracle_has_rows(spark, sf_dir, mart, name):
    assert driver.queries()[name](spark, sf_dir).count() > 0


def test_command_line():
    args = parser().parse_args(["score", "--snapshotdate", "2024-01-01", "--modelname", "m.pkl"])
    assert (args.job, args.end, args.bank) == ("score", None, "model_bank")
    assert parser().parse_args(["train", "--snapshotdate", "2024-09-01"]).candidates == 100


def test_training_rows_table_equals_the_join(spark, sf_dir, mart, tmp_path):
    from arrears.plans import datamart
    from catalogue.fixtures import CALENDAR

    labels, features = datamart.read_labels(spark, mart.labels), mart.features
    plain = join_features(in_window(labels, CALENDAR), in_window(features, CALENDAR))
    plain = plain.withColumn("segment", segment(CALENDAR))
    for _ in range(2):  # a rerun replaces the table
        table = training.build_training_rows(spark, labels, features, CALENDAR, str(tmp_path))
    assert table.columns == plain.columns
    assert table.exceptAll(plain).count() == 0 and table.count() == plain.count()
    assert table.where("fe_1 IS NULL").count() > 0

"""What the plans read, shuffle and push down."""

import re

import pytest

import __spark_entry__ as driver
from arrears.operators import metrics, scaling
from arrears.operators.training_set import join_features
from arrears.plans import datamart, scoring
from arrears.sources.sinks import overwrite_months
from arrears.sources.tables import between_days, in_months, read_features
from catalogue.store import store


@pytest.fixture(autouse=True)
def full_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return [set(re.findall(r"(\w+):", schema)) for schema in schemas]


@pytest.mark.parametrize("name, columns", [
    ("silver_mob", {"o_orderkey", "o_custkey", "o_orderdate"}),
    ("gold_label", {"o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"}),
    ("month_spine", {"o_orderkey", "o_custkey", "o_orderdate"}),
])
def test_only_the_needed_columns_are_read(spark, sf_dir, name, columns):
    found = read_columns(plan_of(driver.queries()[name](spark, sf_dir)))
    assert found and all(schema <= columns for schema in found)


def test_features_read_six_columns_of_the_lines(spark, sf_dir):
    plan = plan_of(driver.queries()["feature_window"](spark, sf_dir))
    names = ("orderkey", "quantity", "extendedprice", "discount", "returnflag", "shipdate")
    assert {f"l_{name}" for name in names} in read_columns(plan)


@pytest.mark.parametrize(
    "name", ["silver_dpd", "gold_label", "dpd_flag", "completed_loans", "actual_bads"]
)
def test_row_wise_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(driver.queries()[name](spark, sf_dir))


def test_parquet_features_are_pruned_by_month(spark, tmp_path):
    df = spark.range(50).selectExpr(
        "cast(id AS string) AS Customer_ID",
        "add_months(date'2023-01-01', int(id % 5)) AS snapshot_date",
        "rand(1) AS fe_1", "rand(2) AS fe_2",
    )
    path = str(tmp_path / "features")
    overwrite_months(df, path, [])
    features = read_features(spark, path, "parquet")
    for wanted in (in_months(["2023-02-01"]), between_days("2023-02-01", "2023-03-31")):
        plan = plan_of(features.where(wanted).select("Customer_ID", "fe_2"))
        assert "2023-02-01" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
        assert read_columns(plan) == [{"Customer_ID", "fe_2"}]


def test_scaler_is_one_aggregation(spark, sf_dir):
    rows = store(spark, sf_dir).training_set
    plan = plan_of(scaling.fit_scaler(rows, [f"fe_{i}" for i in range(1, 8)]))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_auc_reads_the_scores_twice_and_ranks_by_range(spark, sf_dir):
    plan = plan_of(metrics.auc(store(spark, sf_dir).training_set, "split", "fe_7"))
    assert plan.count("FileScan") == 2
    assert re.search(r"Window \[sum\(neg[^\n]*\[split#\d+, range#\d+\]", plan)


def test_join_splits_hot_keys_on_both_sides(spark):
    """The large side of an inner join may be either; a left outer join could split the left only."""
    labels = spark.range(10).selectExpr(
        "'x' AS Customer_ID", "date'2023-01-01' AS snapshot_date", "id AS loan_id")
    features = spark.range(10).selectExpr(
        "'x' AS Customer_ID", "date'2023-01-01' AS snapshot_date", "rand() AS fe_1")
    plan = join_features(labels, features)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Join LeftAnti" in plan and "LeftOuter" not in plan


def test_the_model_of_the_audit_is_fitted_on_the_audited_layers(spark, sf_dir, monkeypatch):
    built, fitted_on = [], []

    def noted(name):
        build = getattr(datamart, name)

        def call(*args, **more):
            built.append(name)
            return build(*args, **more)

        return call

    def fit(spark, labels, *args, **more):
        fitted_on.append(labels.count())
        return "model"

    monkeypatch.setattr("catalogue.store._stores", {})
    monkeypatch.setattr("catalogue.store.train", fit)
    monkeypatch.setattr(scoring, "score", lambda *args: None)
    for name in ("build_bronze", "build_silver", "build_labels"):
        monkeypatch.setattr(datamart, name, noted(name))
    counts = {(r.job, r.step): r.n for r in driver.queries()["audit_counts"](spark, sf_dir).collect()}
    assert built == ["build_bronze", "build_silver", "build_labels"]
    assert fitted_on == [counts["labels", "labels"]]

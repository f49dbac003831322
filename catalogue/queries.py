"""One query per operator, each over the whole of its input tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.functions.dates import (
    MODEL_SUFFIX,
    calendar_columns,
    date_key,
    model_version,
    month_spine,
    version_column,
)
from arrears.functions.delinquency import conform
from arrears.layout import Layout
from arrears.operators import labels as lab
from arrears.operators import metrics, silver, training_set, types
from arrears.operators.boosting import Settings, fit_all
from arrears.operators.model import MODEL_SEED, SEARCH_SPACE, boosted_pipeline, classifier, fitted_pipeline, preparation
from arrears.operators.scaling import Scaler, fit_scaler
from arrears.plans import datamart, incremental, scoring, training, vintage
from arrears.plans.audit import Audit, read_audit
from arrears.schemas import KEYS, LABEL_TYPES, LOAN_TYPES, feature_columns
from arrears.sources.published import read_published
from arrears.sources.tables import in_months, read_csv
from catalogue.fixtures import (
    CALENDAR,
    CUTOFF,
    MONTHS,
    POINT,
    TRAIN_DATE,
    drifting_feed,
    feature_clickstream,
    loan_daily,
)
from catalogue.store import store, write_feed

Query = Callable[[SparkSession, str], DataFrame]

VERSION = model_version(TRAIN_DATE)
STUMP_FEATURES = ["fe_4", "fe_5"]
# Two trees of two levels with every penalty: small enough for SQL to fit them as well.
BOOSTED = {
    "n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "gamma": 0.1, "min_child_weight": 3, "reg_alpha": 0.5, "reg_lambda": 1.5,
}
NUMBERS = ["tenure", "installment_num", "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]

# Raw text to the feed's own types; amounts are not yet narrowed to float.
RAW_TYPES = {
    name: "double" if kind == "float" else kind for name, kind in LOAN_TYPES.items()
}


def widen(df: DataFrame) -> DataFrame:
    """Show float columns as double, digit by digit what is stored."""
    return df.withColumns(
        {name: F.col(name).cast("double") for name, kind in df.dtypes if kind == "float"}
    )


def raw_typed(df: DataFrame) -> DataFrame:
    return df.select(*[conform(name, kind).alias(name) for name, kind in RAW_TYPES.items()])


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_loans(loan_daily(spark, sf_dir))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.label_loans(silver_of(spark, sf_dir))


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark, sf_dir).training_rows


def split_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark, sf_dir).training_set


# --- calendar ---------------------------------------------------------------


def month_coverage(spark, sf_dir):
    loans = loan_daily(spark, sf_dir)
    counts = loans.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    span = loans.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
    spine = span.select(F.explode(month_spine(F.col("first"), F.col("last"))).alias("snapshot_date"))
    return spine.join(counts, "snapshot_date", "left").select(
        "snapshot_date", F.coalesce("n", F.lit(0)).alias("n")
    )


def train_calendar(spark, sf_dir):
    dates = labels_of(spark, sf_dir).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_labels"))
    columns = calendar_columns(F.col("snapshot_date"))
    return dates.select(*[column.alias(name) for name, column in columns.items()], "n_labels")


def date_keys(spark, sf_dir):
    months = loan_daily(spark, sf_dir).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    version = version_column(F.col("snapshot_date"))
    return months.select(
        "snapshot_date",
        date_key(F.col("snapshot_date")).alias("date_key"),
        version.alias("model_version"),
        F.concat(version, F.lit(MODEL_SUFFIX)).alias("model_file"),
        "n",
    )


# --- scans and builds -------------------------------------------------------


def csv_scan(spark, sf_dir):
    return raw_typed(read_csv(spark, store(spark, sf_dir).raw))


def feature_scan(spark, sf_dir):
    return store(spark, sf_dir).features


def bronze_snapshot(spark, sf_dir):
    return datamart.snapshots(loan_daily(spark, sf_dir), [POINT])


def bronze_backfill(spark, sf_dir):
    mart = store(spark, sf_dir)
    bronze = datamart.build_bronze(spark, mart.raw, mart.folder("bronze_backfill"), MONTHS)
    amount = F.col("overdue_amt").cast("decimal(38,3)")
    return bronze.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).cast("double").alias("overdue_amt")
    )


def bronze_scan(spark, sf_dir):
    return raw_typed(datamart.read_bronze(spark, store(spark, sf_dir).bronze, [POINT]))


def silver_backfill(spark, sf_dir):
    mart = store(spark, sf_dir)
    path = mart.folder("silver_backfill")
    datamart.build_silver(spark, mart.bronze, path, MONTHS)
    datamart.build_silver(spark, mart.bronze, path, [POINT])
    return widen(datamart.read_silver(spark, path))


def silver_scan(spark, sf_dir):
    table = datamart.read_silver(spark, store(spark, sf_dir).silver)
    return widen(table.where(in_months([POINT])))


def gold_backfill(spark, sf_dir):
    mart = store(spark, sf_dir)
    return datamart.build_labels(spark, mart.silver, mart.folder("gold_backfill"), MONTHS)


def label_store_scan(spark, sf_dir):
    table = datamart.read_labels(spark, store(spark, sf_dir).labels)
    return table.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")
    )


def layer_counts(spark, sf_dir):
    mart = store(spark, sf_dir)
    return datamart.layer_counts(
        bronze=datamart.read_bronze(spark, mart.bronze),
        silver=datamart.read_silver(spark, mart.silver, others=False),
        gold=datamart.read_labels(spark, mart.labels),
    )


# --- silver columns ---------------------------------------------------------


def silver_conform(spark, sf_dir):
    return widen(silver.conform_loans(loan_daily(spark, sf_dir)))


def silver_columns(*columns: str) -> Query:
    def query(spark, sf_dir):
        return widen(silver_of(spark, sf_dir).select(*KEYS, *columns))

    return query


# --- labels and vintage -----------------------------------------------------


def gold_label(spark, sf_dir):
    return labels_of(spark, sf_dir)


def completed_loans(spark, sf_dir):
    done = lab.started_before(silver_of(spark, sf_dir), CUTOFF)
    return done.select(*KEYS, "loan_start_date", "mob", "dpd")


def dpd_flag(spark, sf_dir):
    return lab.flag_dpd(silver_of(spark, sf_dir)).select(*KEYS, "mob", "dpd", "dpd_flag")


def actual_bads(spark, sf_dir):
    flagged = lab.flag_dpd(lab.started_before(silver_of(spark, sf_dir), CUTOFF))
    return lab.at_installment(flagged).select(*KEYS, "dpd_flag")


def bad_rate_by_mob(spark, sf_dir):
    return vintage.vintage_report(spark, store(spark, sf_dir).silver, CUTOFF)


# --- training set -----------------------------------------------------------


def label_window(spark, sf_dir):
    return training_set.in_window(labels_of(spark, sf_dir), CALENDAR)


def feature_window(spark, sf_dir):
    return training_set.in_window(feature_clickstream(spark, sf_dir), CALENDAR)


def training_join(spark, sf_dir):
    return rows_of(spark, sf_dir).drop("segment")


def oot_split(spark, sf_dir):
    return rows_of(spark, sf_dir).select(*KEYS, "label", "segment")


def stratified_split(spark, sf_dir):
    return split_of(spark, sf_dir).select(*KEYS, "label", "split")


def split_stats(spark, sf_dir):
    return training_set.split_stats(split_of(spark, sf_dir))


def feature_select(spark, sf_dir):
    features = feature_clickstream(spark, sf_dir)
    return features.select(*feature_columns(features.columns))


def training_matrix(spark, sf_dir):
    return training_set.training_matrix(split_of(spark, sf_dir), "loan_id", "split")


def scaler_fit(spark, sf_dir):
    rows = split_of(spark, sf_dir).where(F.col("split") == "train")
    stats = fit_scaler(rows, feature_columns(rows.columns))
    return stats.select(
        "feature", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"), "n"
    )


def scaler_apply(spark, sf_dir):
    rows = split_of(spark, sf_dir)
    names = feature_columns(rows.columns)
    scaled = Scaler.fit(rows.where(F.col("split") == "train"), names).transform(rows)
    return scaled.select(*KEYS, "split", *[
        (F.round(name, 6) + 0.0).alias(name.replace("fe_", "z_")) for name in names
    ])


# --- metrics ----------------------------------------------------------------


def auc(spark, sf_dir):
    return metrics.auc(split_of(spark, sf_dir), by="split", score="fe_7")


def gini(spark, sf_dir):
    return auc(spark, sf_dir).select("split", metrics.gini(F.col("auc")).alias("gini"))


def auc_hard(spark, sf_dir):
    rows = split_of(spark, sf_dir).where(F.col("fe_7").isNotNull())
    predicted = rows.withColumn("prediction", (F.col("fe_7") >= 70).cast("int"))
    return metrics.hard_auc(predicted, by="split", prediction="prediction")


# --- model and scoring ------------------------------------------------------


def score_input(spark, sf_dir):
    return feature_clickstream(spark, sf_dir).where(in_months([POINT]))


def audit_counts(spark, sf_dir):
    """Rows that each job saw at its loads and filters, of one run of all jobs but the training's search.

    The model that scores is fitted on the layers of this run, unless the store has a model or layers already.
    """
    mart = store(spark, sf_dir)
    table = mart.folder(f"audit-{uuid.uuid4().hex}")
    audits = {job: Audit(spark, table, job) for job in ("bronze", "silver", "labels", "training", "scoring")}
    root = mart.folder(f"audited-{uuid.uuid4().hex}")
    bronze, silver, labels = (f"{root}/{name}" for name in ("bronze", "silver", "labels"))
    datamart.build_bronze(spark, mart.raw, bronze, MONTHS, audit=audits["bronze"])
    datamart.build_silver(spark, bronze, silver, MONTHS, audit=audits["silver"])
    stored = datamart.build_labels(spark, silver, labels, MONTHS, audit=audits["labels"])
    mart.adopt(bronze=bronze, silver=silver, labels=labels)
    training.build_training_rows(spark, stored, mart.features, CALENDAR, f"{root}/bank", audits["training"])
    scoring.score(
        spark, mart.features, mart.run and mart.bank, VERSION + MODEL_SUFFIX, f"{root}/predictions", [POINT], audits["scoring"]
    )
    for audit in audits.values():
        audit.close()
    return read_audit(spark, table).select("job", "step", "place", "n")


def incremental_backfill(spark, sf_dir):
    """Rows of silver and gold after late rows in one month, and the layers that the second refresh rebuilt."""
    mart = store(spark, sf_dir)
    layout = Layout(mart.folder(f"incremental-{uuid.uuid4().hex}"))
    feed = f"{layout.mart}/feed"
    loans = loan_daily(spark, sf_dir)
    late = (F.col("snapshot_date") == F.lit(POINT)) & F.col("loan_id").endswith("7")
    write_feed(loans.where(~late), feed)
    incremental.refresh(spark, feed, layout, MONTHS)
    write_feed(loans.where(late), feed, "append")
    again = incremental.refresh(spark, feed, layout, MONTHS)
    built = incremental.read_record(spark, layout).where(F.col("run") == again.run)
    counts = datamart.layer_counts(
        silver=datamart.read_silver(spark, layout.silver, others=False), gold=datamart.read_labels(spark, layout.labels)
    )
    return counts.join(F.broadcast(built.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rebuilt"))), "snapshot_date", "left").select(
        "layer", "snapshot_date", "n", F.coalesce("n_rebuilt", F.lit(0)).alias("n_rebuilt")
    )


def published_labels(spark, sf_dir):
    """A published label store after a second run that empties one month and refills another."""
    mart = store(spark, sf_dir)
    path = mart.folder(f"published-{uuid.uuid4().hex}")
    silver_rows = datamart.read_silver(spark, mart.silver, others=False)
    datamart.publish_labels(silver_rows, path, MONTHS)
    again = silver_rows.where(F.col("snapshot_date") != F.lit(POINT))
    datamart.publish_labels(again, path, [POINT, MONTHS[0]], dpd=60)
    return read_published(spark, path, LABEL_TYPES)


def month_types(spark, sf_dir):
    """Types of each month's columns, of the feed with a branch code whose type changes over the years."""
    path = store(spark, sf_dir).folder(f"drifting-{uuid.uuid4().hex}")
    write_feed(drifting_feed(spark, sf_dir), path)
    return types.month_types(types.month_kinds(read_csv(spark, path)))


def few_rows():
    """Window over all rows of a table of a few: inputs of a model, candidates of a search."""
    return Window.partitionBy(F.lit(0))


def gbt_train(spark, sf_dir):
    """Inputs of the fitted model; their importances are shares of 1."""
    inputs = training.importance_table(spark, store(spark, sf_dir).run)
    return inputs.select(
        "feature",
        F.col("importance").between(0, 1).cast("int").alias("is_share"),
        F.round(F.sum("importance").over(few_rows()), 6).alias("total"),
    )


def random_search(spark, sf_dir):
    """The drawn candidates, whether each has a score, and how many are best."""
    table = training.search_table(spark, store(spark, sf_dir).run.search)
    return table.select(
        "candidate", *SEARCH_SPACE,
        F.col("cv_auc_hard").between(0, 1).cast("int").alias("is_scored"),
        F.count_if("is_best").over(few_rows()).alias("n_best"),
    )


def eval_report(spark, sf_dir):
    report = store(spark, sf_dir).run.report
    return report.select(
        "split", "n", "event_rate",
        F.col("auc").between(0, 1).cast("int").alias("is_auc"),
        F.col("gini").eqNullSafe(metrics.gini(F.col("auc"))).cast("int").alias("gini_follows_auc"),
    )


def stump_of(spark, sf_dir):
    """Scores of one tree with one split, on features of few values: SQL can fit it too."""
    rows = split_of(spark, sf_dir)
    train = rows.where(F.col("split") == "train")
    scaler = Scaler.fit(train, STUMP_FEATURES)
    matrix = train.select(F.col("label").cast("double").alias("label"), *STUMP_FEATURES)
    for stage in preparation(scaler):
        matrix = stage.transform(matrix)
    model = classifier({"n_estimators": 1, "max_depth": 1}, train.count()).fit(matrix)
    return training.score_splits(fitted_pipeline(scaler, model), rows)


def stump_scores(spark, sf_dir):
    return stump_of(spark, sf_dir).select(*KEYS, "split", "label", F.round("score", 6).alias("score"))


def stump_report(spark, sf_dir):
    report = training.evaluate(stump_of(spark, sf_dir))
    return report.withColumn("auc", F.round("auc", 6))


def boosted_of(spark, sf_dir):
    """Scores of the library's own boosted trees, on features of few values with missing ones among them."""
    rows = split_of(spark, sf_dir)
    train = rows.where(F.col("split") == "train")
    scaler = Scaler.fit(train, STUMP_FEATURES)
    blocks = training.packed_rows(train, scaler, store(spark, sf_dir).folder("boosted"))
    (model,) = next(fit_all(blocks, [Settings(**BOOSTED)], MODEL_SEED))
    return training.score_splits(boosted_pipeline(scaler, model), rows)


def gbt_scores(spark, sf_dir):
    return boosted_of(spark, sf_dir).select(*KEYS, "split", "label", F.round("score", 6).alias("score"))


def gbt_report(spark, sf_dir):
    return training.evaluate(boosted_of(spark, sf_dir)).withColumn("auc", F.round("auc", 6))


def model_registry(spark, sf_dir):
    row = store(spark, sf_dir).run.registry
    checked = [
        F.col(f"results.gini_{name}").eqNullSafe(metrics.gini(F.col(f"results.auc_{name}")))
        for name in ("train", "test", "oot")
    ]
    return row.select(
        "model_version",
        F.array_join("features", ",").alias("features"),
        "data_dates.*",
        "data_stats.*",
        F.size("hp_params").alias("n_params"),
        F.size("applied_params").alias("n_applied"),
        (checked[0] & checked[1] & checked[2]).cast("int").alias("gini_follows_auc"),
    )


def model_reload(spark, sf_dir):
    mart = store(spark, sf_dir)
    check = training.reload_check(spark, mart.bank, mart.run)
    oot = mart.run.training_set.where(F.col("split") == "oot")
    rows = oot.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return check.join(F.broadcast(rows), "split").select(
        "split", "n", F.col("equal").cast("int").alias("equal")
    )


def batch_score(spark, sf_dir):
    mart = store(spark, sf_dir)
    scored = scoring.score_rows(
        mart.features, mart.run.pipeline, list(mart.run.scaler.mean), VERSION + MODEL_SUFFIX, [POINT]
    )
    return scored.select(
        "Customer_ID", "snapshot_date", "model_name", is_probability().alias("is_probability")
    )


def prediction_store(spark, sf_dir):
    mart = store(spark, sf_dir)
    stored = scoring.score(
        spark, mart.features, mart.run and mart.bank, VERSION + MODEL_SUFFIX, mart.predictions, [POINT]
    )
    return stored.select(
        "Customer_ID", "snapshot_date", "model_name", is_probability().alias("is_probability")
    )


def score_backfill(spark, sf_dir):
    mart = store(spark, sf_dir)
    scored = scoring.score(
        spark, mart.features, mart.run and mart.bank, VERSION + MODEL_SUFFIX,
        mart.folder("score_backfill"), MONTHS,
    )
    return scored.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_probability()).alias("n_probabilities")
    )


def is_probability() -> Column:
    return F.col("model_predictions").between(0, 1).cast("int")


QUERIES: dict[str, Query] = {
    "month_spine": month_coverage,
    "train_calendar": train_calendar,
    "date_keys": date_keys,
    "csv_scan": csv_scan,
    "feature_scan": feature_scan,
    "bronze_snapshot": bronze_snapshot,
    "bronze_backfill": bronze_backfill,
    "bronze_scan": bronze_scan,
    "silver_conform": silver_conform,
    "silver_mob": silver_columns("mob"),
    "silver_missed": silver_columns("due_amt", "overdue_amt", "installments_missed"),
    "silver_fill": silver_columns(*NUMBERS),
    "silver_first_missed": silver_columns("installments_missed", "first_missed_date"),
    "silver_dpd": silver_columns("overdue_amt", "dpd"),
    "silver_backfill": silver_backfill,
    "silver_scan": silver_scan,
    "gold_label": gold_label,
    "gold_backfill": gold_backfill,
    "label_store_scan": label_store_scan,
    "layer_counts": layer_counts,
    "completed_loans": completed_loans,
    "dpd_flag": dpd_flag,
    "actual_bads": actual_bads,
    "bad_rate_by_mob": bad_rate_by_mob,
    "label_window": label_window,
    "feature_window": feature_window,
    "training_join": training_join,
    "oot_split": oot_split,
    "stratified_split": stratified_split,
    "split_stats": split_stats,
    "feature_select": feature_select,
    "training_matrix": training_matrix,
    "scaler_fit": scaler_fit,
    "scaler_apply": scaler_apply,
    "auc": auc,
    "gini": gini,
    "auc_hard": auc_hard,
    "score_input": score_input,
    "audit_counts": audit_counts,
    "incremental_backfill": incremental_backfill,
    "month_types": month_types,
    "published_labels": published_labels,
    "gbt_train": gbt_train,
    "random_search": random_search,
    "eval_report": eval_report,
    "stump_scores": stump_scores,
    "stump_report": stump_report,
    "gbt_scores": gbt_scores,
    "gbt_report": gbt_report,
    "model_registry": model_registry,
    "model_reload": model_reload,
    "batch_score": batch_score,
    "prediction_store": prediction_store,
    "score_backfill": score_backfill,
}

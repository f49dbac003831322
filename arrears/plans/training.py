"""Training job: labels and features in, registered model and report out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.dates import TrainingCalendar, model_version
from arrears.functions.digest import digest_parts, digest_text
from arrears.operators.boosting import Blocks, pack
from arrears.operators.metrics import auc, gini
from arrears.operators.model import (
    MODEL_SEED,
    SEARCH_CANDIDATES,
    SEARCH_FOLDS,
    boosted_pipeline,
    draw_candidates,
    probability,
    scaled_inputs,
    scaled_names,
)
from arrears.operators.scaling import Scaler
from arrears.operators.search import BoostedSearch, Ledger, boosted_search
from arrears.operators.split import TRAIN_RATIO, stratified_split
from arrears.operators.training_set import (
    in_window,
    matched_rows,
    segment,
    split_stats,
    unmatched_rows,
)
from arrears.plans.audit import UNSEEN, Audit
from arrears.plans.registry import load_model, register
from arrears.schemas import KEYS, feature_columns, quoted
from arrears.session import work_dir
from arrears.sources.published import current_folder, publish_folder
from arrears.sources.tables import ROW_ID, read_numbered


@dataclass(frozen=True)
class TrainingRun:
    version: str
    training_set: DataFrame
    scaler: Scaler
    search: BoostedSearch
    pipeline: PipelineModel
    report: DataFrame
    registry: DataFrame


def build_training_rows(
    spark: SparkSession,
    labels: DataFrame,
    features: DataFrame,
    cal: TrainingCalendar,
    bank: str,
    audit: Audit = UNSEEN,
) -> DataFrame:
    """Labels of the calendar's windows with features and time segment, as a table that all later steps read.

    The matched rows are written first. Their keys then show which label rows
    are left, so the feature feed is read once and only the keys that found a
    label are shuffled again. Readers see the table once both parts are there.
    """
    name = uuid.uuid4().hex
    path = f"{joined_path(bank, cal)}/{name}"
    wanted = in_window(labels, cal)
    given = audit.seen(in_window(audit.seen(features, "features loaded"), cal), "features in window")
    matched = audit.seen(matched_rows(audit.seen(wanted, "labels in window"), given), "labels with features")
    matched.withColumn("segment", segment(cal)).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    rest = audit.seen(unmatched_rows(wanted, written), "labels without features").withColumn("segment", segment(cal))
    same_columns = written.where(F.lit(False)).unionByName(rest, allowMissingColumns=True)
    same_columns.write.mode("append").parquet(path)
    publish_folder(spark, joined_path(bank, cal), name)
    return spark.read.parquet(path)


def build_training_set(
    spark: SparkSession,
    cal: TrainingCalendar,
    bank: str,
    ratio: float = TRAIN_RATIO,
    folds: int = SEARCH_FOLDS,
) -> DataFrame:
    """The joined rows of :func:`build_training_rows` with split and fold.

    Only the cuts are computed; placing the rows is a projection on reading.
    """
    joined = read_numbered(spark, current_folder(spark, joined_path(bank, cal)))
    return stratified_split(joined, folds=folds, ratio=ratio, row_id=ROW_ID)


def joined_path(bank: str, cal: TrainingCalendar) -> str:
    return f"{training_path(bank, cal)}/joined"


def training_path(bank: str, cal: TrainingCalendar) -> str:
    return f"{bank}/training_sets/{model_version(cal.train_date)}"


def evaluate(scored: DataFrame, score: str = "score") -> DataFrame:
    """Rows, event rate, AUC and Gini of each split."""
    aucs = auc(scored, by="split", score=score)
    return (
        split_stats(scored).join(F.broadcast(aucs), "split", "left")
        .select("split", "n", "event_rate", "auc", gini(F.col("auc")).alias("gini"))
    )


def score_splits(pipeline: PipelineModel, training_set: DataFrame) -> DataFrame:
    scored = pipeline.transform(training_set)
    return scored.select(*KEYS, "split", "label", probability(scored).alias("score"))


def train(
    spark: SparkSession,
    labels: DataFrame,
    features: DataFrame,
    train_date: date | str,
    bank: str,
    n_iter: int = SEARCH_CANDIDATES,
    folds: int = SEARCH_FOLDS,
    ratio: float = TRAIN_RATIO,
    space: dict[str, list] | None = None,
    seed: int = MODEL_SEED,
    audit: Audit = UNSEEN,
) -> TrainingRun:
    """Search, fit, evaluate and register the model of a training date.

    A run that died goes on from the search's ledger: fits on the same rows that
    ended are not repeated.
    """
    work_dir(spark)  # a folder that all executors share is needed
    cal = TrainingCalendar.of(train_date)
    version = model_version(cal.train_date)
    build_training_rows(spark, labels, features, cal, bank, audit)
    rows = build_training_set(spark, cal, bank, ratio, folds)
    train_rows = rows.where(F.col("split") == "train")
    scaler = Scaler.fit(train_rows, feature_columns(rows.columns))

    blocks = packed_rows(train_rows, scaler, f"{training_path(bank, cal)}/search")
    ledger = Ledger(spark, f"{bank}/search_ledger", training_digest(train_rows, scaler), seed)
    search = boosted_search(blocks, draw_candidates(n_iter, space), folds, seed, ledger)

    pipeline = boosted_pipeline(scaler, search.model)
    scored = f"{training_path(bank, cal)}/scored"
    score_splits(pipeline, rows).write.mode("overwrite").parquet(scored)
    report = evaluate(spark.read.parquet(scored))
    splits = report.collect()  # one row per split
    for row in splits:
        audit.known(row.n, row.split)
    drawn = search.candidates[search.best]
    entry = register(
        spark, bank, version, pipeline, cal, ratio, scaler,
        splits,
        drawn,
        {name: getattr(search.model.settings, name) for name in drawn},
    )
    return TrainingRun(version, rows, scaler, search, pipeline, report, entry)


def packed_rows(train_rows: DataFrame, scaler: Scaler, path: str) -> Blocks:
    """The training rows with scaled features, binned and packed; a row is named by its keys."""
    scaled = scaled_inputs(scaler).transform(train_rows)
    return pack(
        scaled, [F.col(name) for name in scaled_names(scaler)], F.col("label"), F.xxhash64(*map(quoted, KEYS)), path, F.col("fold")
    )


def training_digest(train_rows: DataFrame, scaler: Scaler) -> str:
    """Names the rows a search runs on, in any order: keys, label, fold and features."""
    columns = [*KEYS, "label", "fold", *scaler.mean]
    return train_rows.agg(*digest_parts(columns)).select(digest_text().alias("digest")).first().digest


def search_table(spark: SparkSession, search: BoostedSearch) -> DataFrame:
    """One row per candidate: its parameters, score and whether it won."""
    return spark.createDataFrame([
        {"candidate": i}
        | {name: float(value) for name, value in candidate.items()}
        | {"cv_auc_hard": search.scores[i], "is_best": i == search.best}
        for i, candidate in enumerate(search.candidates)
    ])


def importance_table(spark: SparkSession, run: TrainingRun) -> DataFrame:
    """One row per input of the model with its importance."""
    names = list(run.scaler.mean)
    weights = run.search.model.importances()
    return spark.createDataFrame(
        [(name, float(weight)) for name, weight in zip(names, weights, strict=True)],
        "feature string, importance double",
    )


def reload_check(spark: SparkSession, bank: str, run: TrainingRun) -> DataFrame:
    """Out-of-time AUC of the model in memory and of the model loaded from the bank."""
    loaded, _ = load_model(spark, bank, run.version)
    oot = run.training_set.where(F.col("split") == "oot")
    before = auc(score_splits(run.pipeline, oot), by="split", score="score")
    after = auc(score_splits(loaded, oot), by="split", score="score")
    return (
        before.withColumnRenamed("auc", "auc_before")
        .join(F.broadcast(after.withColumnRenamed("auc", "auc_after")), "split")
        .withColumn("equal", F.col("auc_before").eqNullSafe(F.col("auc_after")))
    )

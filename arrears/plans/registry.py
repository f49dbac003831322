"""Model bank: a saved pipeline per version and one table that describes them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from arrears.functions.dates import TrainingCalendar, version_of
from arrears.operators.scaling import Scaler
from arrears.schemas import ddl

_DATES = ["train_date", "train_test_start", "train_test_end", "oot_start", "oot_end"]
_SPLITS = ["train", "test", "oot"]


def _struct(**fields: str) -> str:
    return "struct<" + ", ".join(f"{name}: {kind}" for name, kind in fields.items()) + ">"


def _per_split(*names: str, kind: str) -> dict[str, str]:
    return {f"{name}_{split}": kind for name in names for split in _SPLITS}


REGISTRY_TYPES = {
    "model_version": "string",
    "features": "array<string>",
    "stdscaler": _struct(mean="map<string, double>", scale="map<string, double>"),
    "data_dates": _struct(**dict.fromkeys(_DATES, "date"), train_test_ratio="double"),
    "data_stats": _struct(
        **_per_split("n", kind="bigint"), **_per_split("event_rate", kind="double")
    ),
    "results": _struct(**_per_split("auc", "gini", kind="double")),
    "hp_params": "map<string, double>",
    "applied_params": "map<string, double>",
}


def registry_path(bank: str) -> str:
    return f"{bank}/model_registry"


def model_path(bank: str, model_name: str) -> str:
    return f"{bank}/{version_of(model_name)}"


def register(
    spark: SparkSession,
    bank: str,
    version: str,
    pipeline: PipelineModel,
    cal: TrainingCalendar,
    ratio: float,
    scaler: Scaler,
    report: list[Row],
    hp_params: dict[str, float],
    applied_params: dict[str, float],
) -> DataFrame:
    """Save a model and its one registry row; a version saved before is replaced.

    ``hp_params`` are the drawn values, ``applied_params`` what the fit was
    given, by Spark's names: not every drawn value has a counterpart.
    """
    pipeline.write().overwrite().save(model_path(bank, version))
    by_split = {row.split: row for row in report}

    def per_split(name: str) -> dict:
        return {f"{name}_{s}": by_split[s][name] if s in by_split else None for s in _SPLITS}

    row = {
        "model_version": version,
        "features": list(scaler.mean),
        "stdscaler": {"mean": scaler.mean, "scale": scaler.scale},
        "data_dates": {name: getattr(cal, name) for name in _DATES} | {"train_test_ratio": ratio},
        "data_stats": per_split("n") | per_split("event_rate"),
        "results": per_split("auc") | per_split("gini"),
        "hp_params": {name: float(value) for name, value in hp_params.items()},
        "applied_params": {name: float(value) for name, value in applied_params.items()},
    }
    df = spark.createDataFrame([row], ddl(REGISTRY_TYPES))
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_version").parquet(registry_path(bank))
    )
    return registry(spark, bank).where(F.col("model_version") == version)


def registry(spark: SparkSession, bank: str) -> DataFrame:
    """All registered models, one row each."""
    df = spark.read.schema(ddl(REGISTRY_TYPES)).parquet(registry_path(bank))
    return df.select(*REGISTRY_TYPES)


def load_model(spark: SparkSession, bank: str, model_name: str) -> tuple[PipelineModel, list[str]]:
    """Saved pipeline and its feature list."""
    version = version_of(model_name)
    row = registry(spark, bank).where(F.col("model_version") == version).select("features").first()
    if row is None:
        raise LookupError(f"no model {version} in {bank}")
    return PipelineModel.load(model_path(bank, version)), list(row.features)

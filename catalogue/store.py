"""Tables and the model that several queries share, built once per session and input."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from arrears.operators.labels import label_loans
from arrears.operators.silver import silver_loans
from arrears.plans import datamart
from arrears.plans.training import (
    TrainingRun,
    build_training_rows,
    build_training_set,
    train,
)
from arrears.session import work_dir
from arrears.sources.sinks import FEED_OPTIONS
from arrears.sources.tables import read_features
from catalogue import fixtures

# Candidates of the checks' search; the job's own default is the full one.
SEARCH_ITERATIONS = 10


class Store:
    """Data mart in a folder of its own; each table is written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = f"{work_dir(spark)}/mart-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def adopt(self, **layers: str) -> None:
        """Take finished layers as this store's own, where it has none yet: no second copy is built."""
        for name, path in layers.items():
            self.__dict__.setdefault(name, path)

    @cached_property
    def raw(self) -> str:
        return self._csv(fixtures.loan_daily(self.spark, self.sf_dir), "raw/loan_daily")

    @cached_property
    def raw_features(self) -> str:
        features = fixtures.feature_clickstream(self.spark, self.sf_dir)
        return self._csv(features, "raw/feature_clickstream")

    @cached_property
    def bronze(self) -> str:
        path = self.folder("bronze")
        datamart.build_bronze(self.spark, self.raw, path, fixtures.MONTHS)
        return path

    @cached_property
    def silver(self) -> str:
        path = self.folder("silver")
        datamart.build_silver(self.spark, self.bronze, path, fixtures.MONTHS)
        return path

    @cached_property
    def labels(self) -> str:
        path = self.folder("gold/label_store")
        datamart.build_labels(self.spark, self.silver, path, fixtures.MONTHS)
        return path

    @cached_property
    def bank(self) -> str:
        return self.folder("model_bank")

    @cached_property
    def predictions(self) -> str:
        return self.folder("gold/model_predictions")

    @property
    def features(self) -> DataFrame:
        return read_features(self.spark, self.raw_features)

    @cached_property
    def training_rows(self) -> DataFrame:
        labels = label_loans(silver_loans(fixtures.loan_daily(self.spark, self.sf_dir)))
        features = fixtures.feature_clickstream(self.spark, self.sf_dir)
        folder = self.folder("training")
        return build_training_rows(self.spark, labels, features, fixtures.CALENDAR, folder)

    @cached_property
    def training_set(self) -> DataFrame:
        assert self.training_rows
        return build_training_set(self.spark, fixtures.CALENDAR, self.folder("training"), folds=1)

    @cached_property
    def run(self) -> TrainingRun:
        return train(
            self.spark,
            datamart.read_labels(self.spark, self.labels),
            self.features,
            fixtures.TRAIN_DATE,
            self.bank,
            n_iter=SEARCH_ITERATIONS,
        )

    def _csv(self, df: DataFrame, name: str) -> str:
        path = self.folder(name)
        write_feed(df, path)
        return path


def write_feed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A raw feed as compressed CSV."""
    df.write.mode(mode).options(**FEED_OPTIONS).csv(path)


_stores: dict[tuple[str, str], Store] = {}


def store(spark: SparkSession, sf_dir: str) -> Store:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        _stores[key] = Store(spark, sf_dir)
    return _stores[key]

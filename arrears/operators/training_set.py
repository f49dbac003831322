"""Labels joined with features and cut into time segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.dates import TrainingCalendar
from arrears.schemas import SNAPSHOT, feature_columns, quoted
from arrears.sources.tables import between_days

JOIN_KEYS = ["Customer_ID", SNAPSHOT]


def in_window(df: DataFrame, cal: TrainingCalendar) -> DataFrame:
    """Rows from the start of the train window to the end of the out-of-time window."""
    return df.where(between_days(cal.train_test_start, cal.oot_end))


def join_features(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Left outer join: every label row, with NULL features where none match.

    It is written as matched rows plus unmatched rows. Adaptive execution can
    split a hot key on both sides of an inner join, but only on the left side
    of a left outer join, where copies of one feature key would all meet in one
    task.
    """
    matched = matched_rows(labels, features)
    return matched.unionByName(unmatched_rows(labels, features), allowMissingColumns=True)


def matched_rows(labels: DataFrame, features: DataFrame) -> DataFrame:
    return labels.join(features, JOIN_KEYS, "inner")


def unmatched_rows(labels: DataFrame, known: DataFrame) -> DataFrame:
    """Label rows whose key is not in ``known``; keys become distinct before the shuffle."""
    return labels.join(known.select(JOIN_KEYS).distinct(), JOIN_KEYS, "left_anti")


def segment(cal: TrainingCalendar) -> Column:
    """``oot``, ``train_test`` or NULL by snapshot date."""
    return (
        F.when(between_days(cal.oot_start, cal.oot_end), "oot")
        .when(between_days(cal.train_test_start, cal.train_test_end), "train_test")
    )


def training_matrix(df: DataFrame, *keep: str) -> DataFrame:
    """Features and the label as double, with the columns to ``keep`` in front."""
    features = map(quoted, feature_columns(df.columns))
    return df.select(*keep, F.col("label").cast("double").alias("label"), *features)


def split_stats(df: DataFrame) -> DataFrame:
    """Rows and event rate, rounded half to even, of each split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.bround(F.avg("label"), 2).alias("event_rate"),
    )

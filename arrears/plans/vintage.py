"""Vintage report from the silver table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from arrears.functions.delinquency import LABEL_DPD
from arrears.operators.labels import bad_rate_curve
from arrears.plans.datamart import read_silver


def vintage_report(
    spark: SparkSession, silver_path: str, cutoff: date | str, dpd: int = LABEL_DPD
) -> DataFrame:
    """Bad rate by month on book of the loans started before ``cutoff``."""
    return bad_rate_curve(read_silver(spark, silver_path, others=False), cutoff, dpd)

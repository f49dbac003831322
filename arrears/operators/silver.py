"""Typed loan snapshots with delinquency columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.delinquency import (
    conform,
    days_past_due,
    first_missed_date,
    installments_missed,
)
from arrears.schemas import LOAN_TYPES, SILVER_TYPES, quoted


def conform_loans(df: DataFrame, date_format: str | None = None) -> DataFrame:
    """Give the known loan columns their silver types; other columns stay as they are."""
    typed = [conform(name, kind, date_format).alias(name) for name, kind in LOAN_TYPES.items()]
    return df.select(*typed, *_others(df))


def add_delinquency(df: DataFrame) -> DataFrame:
    """Add months on book, missed instalments, first missed date and days past due.

    The ratio is taken before the numeric NULLs and NaNs of all columns become
    0, and the dates after it: an unknown due amount therefore leaves no first
    missed date, and an unknown overdue amount counts as nothing overdue.
    """
    counted = df.withColumns({
        "mob": F.col("installment_num"),
        "installments_missed": installments_missed(F.col("overdue_amt"), F.col("due_amt")),
    }).na.fill(0)
    dated = counted.withColumn(
        "first_missed_date",
        first_missed_date(F.col("snapshot_date"), F.col("installments_missed")),
    )
    return dated.withColumn(
        "dpd",
        days_past_due(
            F.col("overdue_amt"), F.col("snapshot_date"), F.col("installments_missed"), F.col("first_missed_date")
        ),
    )


def silver_loans(df: DataFrame, date_format: str | None = None) -> DataFrame:
    """Bronze rows to silver rows: one projection, no shuffle."""
    result = add_delinquency(conform_loans(df, date_format))
    return result.select(*SILVER_TYPES, *_others(result))


def _others(df: DataFrame) -> list[str]:
    return [quoted(name) for name in df.columns if name not in SILVER_TYPES]

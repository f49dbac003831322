"""Label store and bad-rate curve."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.dates import to_day
from arrears.functions.delinquency import LABEL_DPD, LABEL_MOB, is_bad, label_definition
from arrears.schemas import LABEL_TYPES


def label_loans(silver: DataFrame, dpd: int = LABEL_DPD, mob: int = LABEL_MOB) -> DataFrame:
    """One label per loan snapshot at ``mob`` months on book."""
    observed = silver.where(F.col("mob") == mob)
    return observed.withColumns({
        "label": is_bad(F.col("dpd"), dpd),
        "label_def": F.lit(label_definition(dpd, mob)),
    }).select(*LABEL_TYPES)


def flag_dpd(silver: DataFrame, dpd: int = LABEL_DPD) -> DataFrame:
    """Add the bad flag to the snapshots of every month on book."""
    return silver.withColumn("dpd_flag", is_bad(F.col("dpd"), dpd))


def started_before(silver: DataFrame, cutoff: date | str) -> DataFrame:
    """Loans old enough to have run to their end."""
    return silver.where(F.col("loan_start_date") < F.lit(to_day(cutoff)))


def at_installment(silver: DataFrame, number: int = 10) -> DataFrame:
    """Snapshots of one instalment; the last one shows the actual bads."""
    return silver.where(F.col("installment_num") == number)


def bad_rate_curve(silver: DataFrame, cutoff: date | str, dpd: int = LABEL_DPD) -> DataFrame:
    """Share of bad snapshots by month on book, in that order."""
    flagged = flag_dpd(started_before(silver, cutoff), dpd)
    curve = flagged.groupBy("mob").agg(
        F.avg("dpd_flag").alias("bad_rate"),
        F.count(F.lit(1)).alias("n"),
    )
    return curve.orderBy("mob")

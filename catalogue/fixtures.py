"""Loan book and feature table derived from the given order tables.

Each order becomes a loan with one row for each of its 11 monthly snapshots; a
customer's order lines become monthly features. Every row of the inputs counts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.dates import TrainingCalendar, month_list
from arrears.sources.tables import conform_features

# Parameters of the queries.
MONTHS = month_list("1995-01-01", "2002-06-01")
POINT = date(1998, 3, 1)
CUTOFF = date(2000, 1, 1)
TRAIN_DATE = date(1999, 9, 1)

CALENDAR = TrainingCalendar.of(TRAIN_DATE)

_PATTERN = "(o_custkey * 37 + (o_orderkey * 31) % 30) % 100"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan feed. The pattern ``k`` of a loan decides how it pays.

    Loans of pattern 96 owe thousands of tiny instalments; the sixth month of
    pattern 95 is in the feed twice.
    """
    base = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS loan_id",
        "cast(o_custkey AS string) AS Customer_ID",
        "trunc(cast(o_orderdate AS date), 'MM') AS loan_start_date",
        "10 AS tenure",
        f"explode(concat(sequence(0, 10), if({_PATTERN} = 95, array(6), array()))) AS installment_num",
        "o_totalprice AS loan_amt",
        f"{_PATTERN} AS k",
        f"if({_PATTERN} = 96, 0.01E0, floor(o_totalprice * 10) / 100) AS due0",
    )
    paying = base.selectExpr(
        "*",
        "CASE WHEN k = 97 THEN 0.0E0 WHEN k = 99 THEN NULL"
        " WHEN installment_num = 0 THEN 0.0E0 ELSE due0 END AS due_amt",
        "CASE WHEN k = 98 THEN NULL WHEN k = 97 THEN due0"
        " WHEN k = 96 AND installment_num >= 6 THEN 230.0E0"
        " WHEN k < 8 THEN greatest(0, installment_num - 2) * due0"
        " WHEN k < 20 THEN greatest(0, least(installment_num - 4, 2)) * due0"
        " WHEN k < 30 AND installment_num = 6 THEN 0.5E0 * due0 ELSE 0.0E0 END AS overdue_amt",
        "add_months(loan_start_date, installment_num) AS snapshot_date",
    )
    return paying.selectExpr(
        "loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt",
        "due_amt",
        "CASE WHEN overdue_amt IS NOT NULL"
        " THEN greatest(0.0E0, installment_num * due0 - overdue_amt) END AS paid_amt",
        "overdue_amt",
        "due0 * 10 - installment_num * due0 AS balance",
        "snapshot_date",
    )


def feature_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly features of a customer; ``fe_6`` is constant and ``fe_7`` tells the risk.

    Every fiftieth customer's rows are there twice.
    """
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")
    )
    features = lines.groupBy(
        F.expr("cast(o_custkey AS string)").alias("Customer_ID"),
        F.expr("trunc(cast(l_shipdate AS date), 'MM')").alias("snapshot_date"),
    ).agg(
        F.count(F.lit(1)).alias("fe_1"),
        F.sum("l_quantity").alias("fe_2"),
        F.max("l_extendedprice").alias("fe_3"),
        F.min("l_discount").alias("fe_4"),
        F.count_if(F.col("l_returnflag") == "R").alias("fe_5"),
        F.lit(7.0).alias("fe_6"),
        F.max(F.expr("(o_custkey * 37) % 100")).alias("fe_7"),
    )
    # Copies are made of the finished rows: a union would join and group the order lines again.
    copies = F.expr("explode(if(cast(Customer_ID AS bigint) % 50 = 0, array(1, 2), array(1)))").alias("copy")
    return conform_features(features.select("*", copies).drop("copy"))


def drifting_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan feed with a branch code: whole numbers at first, then fractions, a date for a year, text at last."""
    year, number = F.year("snapshot_date"), F.col("Customer_ID").cast("int") % 100
    return loan_daily(spark, sf_dir).withColumn(
        "branch",
        F.when(year < 1996, number.cast("string"))
        .when(year < 1997, F.concat(number.cast("string"), F.lit(".5")))
        .when(year < 1998, F.lit("1997-01-01"))
        .when(year < 1999, F.lit(""))
        .otherwise(F.concat(F.lit("B"), number.cast("string"))),
    )

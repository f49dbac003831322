"""Bronze, silver and gold builds. Each is one Spark job for all its months."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.delinquency import LABEL_DPD, LABEL_MOB, conform
from arrears.operators.labels import label_loans
from arrears.operators.silver import silver_loans
from arrears.plans.audit import UNSEEN, Audit
from arrears.schemas import LABEL_TYPES, SILVER_TYPES, SNAPSHOT, quoted
from arrears.sources.published import read_published, replace_months
from arrears.sources.sinks import overwrite_months
from arrears.sources.tables import in_months, read_csv, read_feed, read_months

Months = Iterable[date | str]


def snapshots(raw: DataFrame, months: Months, date_format: str | None = None) -> DataFrame:
    """Rows of the given snapshot dates, with the date typed."""
    dated = raw.withColumn(SNAPSHOT, conform(SNAPSHOT, "date", date_format))
    return dated.where(in_months(months))


def build_bronze(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    months: Months,
    infer: bool = False,
    date_format: str | None = None,
    fmt: str = "csv",
    rebalance: bool = False,
    audit: Audit = UNSEEN,
) -> DataFrame:
    """Copy the given months of the raw CSV feed, unchanged, into the bronze table.

    The table is CSV like the feed; as parquet it takes less room and later
    reads fetch only the columns they use. Rows are not shuffled: each task
    writes a file for each month it has. ``rebalance`` shuffles the whole feed
    instead, for fewer files from one of many small pieces.
    """
    months = list(months)
    feed = audit.seen(read_csv(spark, raw_path, infer), "feed loaded")
    rows = audit.seen(snapshots(feed, months, date_format), "bronze months")
    overwrite_months(rows, bronze_path, months, fmt, rebalance)
    return read_bronze(spark, bronze_path, months, columns=rows.columns, fmt=fmt)


def read_bronze(
    spark: SparkSession,
    bronze_path: str,
    months: Months | None = None,
    columns: list[str] | None = None,
    infer: bool = False,
    fmt: str = "csv",
) -> DataFrame:
    """Bronze rows, as text unless inferred; only the partitions of ``months`` are read."""
    df = read_feed(spark, bronze_path, fmt, infer).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
    df = df.select(*map(quoted, columns)) if columns else df
    return df if months is None else df.where(in_months(months))


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    months: Months,
    infer: bool = False,
    date_format: str | None = None,
    fmt: str = "csv",
    audit: Audit = UNSEEN,
) -> DataFrame:
    """Silver table of the given months. Bronze files are already laid out by month."""
    months = list(months)
    bronze = audit.seen(read_bronze(spark, bronze_path, months, infer=infer, fmt=fmt), "bronze loaded")
    rows = silver_loans(bronze, date_format)
    overwrite_months(rows, silver_path, months, rebalance=False)
    # The columns are those just written: no footers need to be read for them.
    return read_silver(spark, silver_path, types=dict(rows.dtypes)).where(in_months(months))


def read_silver(
    spark: SparkSession, silver_path: str, others: bool = True, types: dict[str, str] | None = None
) -> DataFrame:
    """Silver rows; the feed's columns that the schema does not name follow its own.

    Finding those takes a look at all footers, unless ``types`` names them.
    """
    return read_months(spark, silver_path, types or SILVER_TYPES, others and types is None)


def build_labels(
    spark: SparkSession,
    silver_path: str,
    label_path: str,
    months: Months,
    dpd: int = LABEL_DPD,
    mob: int = LABEL_MOB,
    audit: Audit = UNSEEN,
) -> DataFrame:
    """Label store of the given months; few rows are left of each silver file."""
    months = list(months)
    silver = audit.seen(read_silver(spark, silver_path, others=False).where(in_months(months)), "silver loaded")
    rows = audit.seen(label_loans(silver, dpd, mob), "labels")
    overwrite_months(rows, label_path, months)
    return read_labels(spark, label_path).where(in_months(months))


def publish_labels(
    silver: DataFrame,
    label_path: str,
    months: Months,
    dpd: int = LABEL_DPD,
    mob: int = LABEL_MOB,
) -> DataFrame:
    """Label store whose months all change at once for its readers; ``label_path`` is a published table."""
    months = list(months)
    replace_months(label_loans(silver.where(in_months(months)), dpd, mob), label_path, months)
    return read_published(silver.sparkSession, label_path, LABEL_TYPES, months)


def publish_silver(bronze: DataFrame, silver_path: str, months: Months, date_format: str | None = None) -> DataFrame:
    """Silver table whose months all change at once for its readers; ``silver_path`` is a published table."""
    months = list(months)
    rows = silver_loans(bronze.where(in_months(months)), date_format)
    replace_months(rows, silver_path, months, rebalance=False)
    return read_published(bronze.sparkSession, silver_path, dict(rows.dtypes), months)


def read_labels(spark: SparkSession, label_path: str) -> DataFrame:
    return read_months(spark, label_path, LABEL_TYPES)


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Rows per layer and month, and rows whose days past due are unknown."""
    parts = [
        df.groupBy(SNAPSHOT).agg(
            F.count(F.lit(1)).alias("n"),
            (F.count_if(F.col("dpd").isNull()) if "dpd" in df.columns
             else F.lit(None).cast("bigint")).alias("n_null_dpd"),
        ).select(F.lit(layer).alias("layer"), SNAPSHOT, "n", "n_null_dpd")
        for layer, df in layers.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts

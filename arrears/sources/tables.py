"""Readers: CSV feeds and month-partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions.dates import to_day
from arrears.functions.delinquency import conform
from arrears.schemas import SNAPSHOT, ddl, feature_columns, quoted


def read_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """CSV with a header line, all columns kept.

    Columns are text unless ``infer`` is set, so that only the header is read
    before the query runs: inference costs a pass over the whole feed and may
    give the months of one feed different types. A file whose header names the
    columns in another order fails the read instead of mixing them up.
    """
    reader = spark.read.options(header=True, inferSchema=infer, enforceSchema=False)
    names = None if infer else _header(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names or []])
    return (reader.schema(schema) if names else reader).csv(path)


def _header(spark: SparkSession, path: str) -> list[str] | None:
    """Column names of a CSV feed as Spark reads them, from its first line.

    Spark lists every file on its own to find that line, with a task for each:
    minutes for a feed of many thousand files. None where Spark must look
    itself: no line, two columns of one name, or a column that is also a folder's.
    """
    lines = spark.read.schema("_line string").text(path)
    first = lines.select("_line").where(F.length(F.trim("_line")) > 0).head()
    if first is None:
        return None
    names = spark.read.option("header", True).csv(spark.sparkContext.parallelize([first[0]], 1)).columns
    folders = [name for name in lines.columns if name != "_line"]
    distinct = {name.lower() for name in [*names, *folders]}
    return names if len(distinct) == len(names) + len(folders) else None


def read_months(spark: SparkSession, path: str, types: dict[str, str], others: bool = False) -> DataFrame:
    """Month-partitioned parquet table, all months, in the order of ``types``.

    With ``others``, the columns that ``types`` does not name come after them;
    finding them takes a look at the footers of all files.
    """
    if not others:
        return spark.read.schema(ddl(types)).parquet(path).select(*types)
    df = spark.read.option("mergeSchema", True).parquet(path)
    known = [F.col(name).cast(kind).alias(name) for name, kind in types.items()]
    return df.select(*known, *[quoted(name) for name in df.columns if name not in types])


#: Columns that tell equal rows of a written table apart.
ROW_ID = ("_file", "_row")


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table with the file and row number of each row."""
    file, row = ROW_ID
    return spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)
    )


def read_feed(spark: SparkSession, path: str, fmt: str = "csv", infer: bool = False) -> DataFrame:
    """A feed as CSV or in a format that carries its own types, such as parquet."""
    return read_csv(spark, path, infer) if fmt == "csv" else spark.read.format(fmt).load(path)


def read_features(
    spark: SparkSession, path: str, fmt: str = "csv", date_format: str | None = None
) -> DataFrame:
    """Feature feed: customer, month and every ``fe_`` column as double."""
    return conform_features(read_feed(spark, path, fmt), date_format)


def conform_features(df: DataFrame, date_format: str | None = None) -> DataFrame:
    """Types of the feature table; columns that are neither key nor feature stay."""
    kinds = {"Customer_ID": "string", SNAPSHOT: "date"}
    kinds |= {name: "double" for name in feature_columns(df.columns)}
    return df.select(*[
        conform(name, kinds[name], date_format).alias(name) if name in kinds else quoted(name)
        for name in df.columns
    ])


def in_months(months: Iterable[date | str], snapshot: Column | None = None) -> Column:
    """Predicate for the given snapshot dates, as date literals so that it prunes."""
    snapshot = F.col(SNAPSHOT) if snapshot is None else snapshot
    return snapshot.isin([to_day(month) for month in months])


def between_days(start: date | str, end: date | str) -> Column:
    """Predicate for an inclusive range of snapshot dates."""
    return F.col(SNAPSHOT).between(F.lit(to_day(start)), F.lit(to_day(end)))

"""Month tables that change for all months of a run at once.

A run writes its months beside the ones that are read, below ``runs/run=<name>``,
and then publishes them: a new version of the manifest says which run holds each
month. The manifest is one file, which appears whole or not at all, and readers
follow its latest version. So full months, emptied months and a run that dies
before the end are all the same to a reader: either every month of the run has
changed, or none. Two runs that publish at the same time would write the same
version; the later one fails and can be repeated.

Months that a later run replaced stay on disk for readers that still use them,
until :func:`superseded_runs` are removed by the table's owner.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.functions.dates import to_day
from arrears.schemas import SNAPSHOT, ddl

# Columns of the manifest; a month without rows has no run.
MANIFEST_TYPES = {SNAPSHOT: "date", "run": "string"}


def stage_months(df: DataFrame, path: str, rebalance: bool = True) -> tuple[str, set[date]]:
    """Write the rows as a run of their own, which no reader sees yet; its name and the months that have rows."""
    run, seen = uuid.uuid4().hex, Observation()
    rows = df.hint("rebalance", SNAPSHOT) if rebalance else df
    rows = rows.observe(seen, F.collect_set(SNAPSHOT).alias("months"))
    rows.write.partitionBy(SNAPSHOT).option("compression", "zstd").parquet(f"{path}/runs/run={run}")
    return run, set(seen.get.get("months") or [])


def publish(spark: SparkSession, path: str, run: str, months: Iterable[date | str], full: set[date]) -> int:
    """Let readers see the run: the new version of the manifest. Of ``months`` those not in ``full`` become empty."""
    version, known = manifest(spark, path)
    own = {to_day(month) for month in months}
    if full - own:
        raise ValueError(f"rows of months that were not asked for: {sorted(full - own)}")
    rows = known | {month: run if month in full else None for month in own}
    table = spark.createDataFrame(sorted(rows.items()), ddl(MANIFEST_TYPES)).coalesce(1)
    table.write.mode("error").parquet(f"{path}/manifest/version={version + 1}")
    return version + 1


def replace_months(df: DataFrame, path: str, months: Iterable[date | str], rebalance: bool = True) -> int:
    """Replace exactly the given months of a published table; the new version."""
    months = list(months)
    run, full = stage_months(df, path, rebalance)
    return publish(df.sparkSession, path, run, months, full)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[date, str | None]]:
    """The latest version, or an earlier one, and the run of each month: one row a month."""
    try:
        table = spark.read.schema(f"{ddl(MANIFEST_TYPES)}, version int").parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    if version is None:
        version = table.agg(F.max("version").alias("version")).first().version or 0
    return version, {row[SNAPSHOT]: row.run for row in table.where(F.col("version") == version).collect()}


def read_published(
    spark: SparkSession, path: str, types: dict[str, str], months: Iterable[date | str] | None = None, version: int | None = None
) -> DataFrame:
    """Rows of a published table, as its latest version has them now; only the given months' files are listed."""
    _, known = manifest(spark, path, version)
    wanted = known if months is None else {day: known.get(day) for day in map(to_day, months)}
    folders = [f"{path}/runs/run={run}/{SNAPSHOT}={month.isoformat()}" for month, run in sorted(wanted.items()) if run]
    if not folders:
        return spark.createDataFrame([], ddl(types))
    return spark.read.schema(ddl(types)).option("basePath", f"{path}/runs").parquet(*folders).select(*types)


def superseded_runs(spark: SparkSession, path: str) -> list[str]:
    """Runs of earlier versions that the latest no longer uses."""
    version, known = manifest(spark, path)
    if not version:
        return []
    table = spark.read.schema(f"{ddl(MANIFEST_TYPES)}, version int").parquet(f"{path}/manifest")
    return sorted({row.run for row in table.select("run").distinct().collect() if row.run} - set(known.values()))


def publish_folder(spark: SparkSession, path: str, name: str) -> int:
    """Let readers of :func:`current_folder` see the folder ``name`` below ``path`` from now on; the new version."""
    version = _latest_folder(spark, path)[0] + 1
    spark.createDataFrame([(name,)], "folder string").coalesce(1).write.mode("error").parquet(f"{path}/current/version={version}")
    return version


def current_folder(spark: SparkSession, path: str) -> str:
    """Path of the folder that was published last."""
    version, name = _latest_folder(spark, path)
    if not version:
        raise LookupError(f"nothing is published in {path}")
    return f"{path}/{name}"


def _latest_folder(spark: SparkSession, path: str) -> tuple[int, str]:
    try:
        table = spark.read.schema("folder string, version int").parquet(f"{path}/current")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, ""
    row = table.orderBy(F.desc("version")).first()
    return (row.version, row.folder) if row else (0, "")

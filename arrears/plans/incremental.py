"""Backfill of the months that changed.

Each layer keeps a record of which source it was built from, month by month: a
digest of the feed's rows for bronze, and the digest its lower layer was built
from for silver and gold. A refresh reads the feed once for the digests, rebuilds
the months whose digest a layer does not have yet, and records them after the
layer is written. A run that dies between two layers is caught up by the next:
only the layers that lag behind are built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.functions.delinquency import LABEL_DPD, LABEL_MOB
from arrears.functions.digest import digest_parts, digest_text
from arrears.functions.dates import to_day
from arrears.layout import Layout
from arrears.plans import datamart
from arrears.schemas import SNAPSHOT, ddl
from arrears.sources.tables import read_csv

# Columns of the record, and the digest of a month without rows.
BUILT_TYPES = {"layer": "string", "snapshot_date": "date", "source": "string", "run": "bigint"}
LAYERS = ["bronze", "silver", "gold"]
EMPTY = "0:0:0"


def feed_digests(feed: DataFrame, months: Iterable[date | str], date_format: str | None = None) -> DataFrame:
    """snapshot_date and digest of the feed's rows, in any order, of each month that has rows."""
    columns = sorted(feed.columns)
    rows = datamart.snapshots(feed, months, date_format)
    return rows.groupBy(SNAPSHOT).agg(*digest_parts(columns)).select(SNAPSHOT, digest_text().alias("source"))


def record_path(layout: Layout) -> str:
    return f"{layout.mart}/built"


def read_record(spark: SparkSession, layout: Layout) -> DataFrame:
    """What each layer's months were last built from: one row a layer and month."""
    latest = Window.partitionBy("layer", SNAPSHOT).orderBy(F.desc("run"))
    table = spark.read.schema(ddl(BUILT_TYPES)).parquet(record_path(layout))
    return table.withColumn("place", F.row_number().over(latest)).where("place = 1").drop("place")


@dataclass(frozen=True)
class Refreshed:
    """Months that a refresh rebuilt, by layer."""

    run: int
    months: dict[str, list[date]]


def refresh(
    spark: SparkSession,
    raw_path: str,
    layout: Layout,
    months: Iterable[date | str],
    date_format: str | None = None,
    dpd: int = LABEL_DPD,
    mob: int = LABEL_MOB,
) -> Refreshed:
    """Bring all layers of the given months up to date with the feed; other months and unchanged ones are not touched."""
    months = sorted({to_day(m) for m in months})
    found = feed_digests(read_csv(spark, raw_path), months, date_format)
    # One row a month, here and in the record.
    wanted = dict.fromkeys(months, EMPTY) | {row[SNAPSHOT]: row.source for row in found.collect()}
    try:
        known = {(row.layer, row[SNAPSHOT]): (row.source, row.run) for row in read_record(spark, layout).collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = {}
    run = 1 + max((last for _, last in known.values()), default=0)
    builds: dict[str, Callable[[list[date]], DataFrame]] = {
        "bronze": lambda some: datamart.build_bronze(spark, raw_path, layout.bronze, some, date_format=date_format),
        "silver": lambda some: datamart.build_silver(spark, layout.bronze, layout.silver, some, date_format=date_format),
        "gold": lambda some: datamart.build_labels(spark, layout.silver, layout.labels, some, dpd, mob),
    }
    # Labels depend on their definition too.
    stamps = {"bronze": "", "silver": "", "gold": f" {dpd}dpd_{mob}mob"}
    rebuilt = {}
    for layer in LAYERS:
        sources = {month: wanted[month] + stamps[layer] for month in months}
        stale = [month for month in months if known.get((layer, month), ("", 0))[0] != sources[month]]
        rebuilt[layer] = stale
        if stale:
            builds[layer](stale)
            rows = [(layer, month, sources[month], run) for month in stale]
            spark.createDataFrame(rows, ddl(BUILT_TYPES)).coalesce(1).write.mode("append").parquet(record_path(layout))
    return Refreshed(run, rebuilt)

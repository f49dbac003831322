"""Writers of month-partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.functions.dates import to_day
from arrears.schemas import SNAPSHOT

#: How feeds are written as CSV: fast gzip. A gzip file is read by one task, so none may be large.
FEED_OPTIONS = {"header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1 << 20}

#: Bytes of files that a task sorts by month before it writes them, and that it deals to open files, which needs no memory for rows.
SORTED_BYTES = 64 << 20
DEALT_BYTES = 128 << 20

#: CSV files that a task has open at a time; with more months it sorts the rows of those left.
OPEN_FILES = 128

_SPLIT_CONF = "spark.sql.files.maxPartitionBytes"
_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def overwrite_months(
    df: DataFrame,
    path: str,
    months: Iterable[date | str],
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Replace exactly the given months of a table; other months stay.

    CSV is written as gzip. ``rebalance`` gathers a month's rows before the write, so that a month gets
    a few full files; a large month is split over many tasks and small months
    share one. Leave it off when the input is already laid out by month, or
    when its tasks hold many rows of each month: they write a file a month.

    A dynamic overwrite touches only the months that have rows. Months that
    have none are seen during the same write and replaced by empty files, so a
    rerun never leaves old rows behind and a reader still finds the month.
    """
    seen = Observation()
    rows = df.hint("rebalance", SNAPSHOT) if rebalance else df
    rows = rows.observe(seen, F.collect_set(SNAPSHOT).alias("months"))
    with nullcontext() if rebalance else _small_splits(df.sparkSession, fmt):
        _writer(rows, fmt).option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT).save(path)

    written = set(seen.get.get("months") or [])
    emptied = sorted({to_day(month) for month in months} - written)
    nothing = df.drop(SNAPSHOT).where(F.lit(False))

    def clear(month: date) -> None:
        _writer(nothing, fmt).save(f"{path}/{SNAPSHOT}={month.isoformat()}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(inheritable_thread_target(df.sparkSession)(clear), emptied))


@contextmanager
def _small_splits(spark: SparkSession, fmt: str) -> Iterator[None]:
    """While it holds, tasks read so little that no spill is needed to lay their rows out by month.

    CSV is written to a file a month at the same time, unsorted. Larger tasks write fewer files,
    each of which costs about as much as some thousand rows.
    """
    most = DEALT_BYTES if fmt == "csv" else SORTED_BYTES
    wanted = {}
    if int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()) > most:
        wanted[_SPLIT_CONF] = str(most)
    if fmt == "csv":
        wanted[_FILES_CONF] = str(OPEN_FILES)
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _writer(df: DataFrame, fmt: str):
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "parquet":
        # Amounts and ids have too many values for dictionaries: looking them up costs more than zstd leaves to save.
        writer = writer.options(**{"compression": "zstd", "parquet.enable.dictionary": "false"})
    if fmt == "csv":
        # Spark trims text on writing CSV unless told not to.
        writer = writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **FEED_OPTIONS)
    return writer

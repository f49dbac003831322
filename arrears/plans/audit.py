"""Row counts that the jobs see while they run, kept as one table.

A job hands its frames through :meth:`Audit.seen` at each load and filter. The
counts ride on the job's own scan as named observations; no row is read twice.
A load that is counted before its filter is read whole, as filters do not move
below a count: the jobs do that for CSV feeds, which are parsed whole anyway, and
count month-partitioned tables after their months are chosen.

Where adaptive execution drops an observed side, as it does for a join whose other
side is empty, the count stays NULL. Tasks that run twice after a lost executor
may count their rows twice.
"""

from __future__ import annotations

import threading
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.schemas import ddl

AUDIT_TYPES = {"run": "string", "at": "timestamp", "job": "string", "step": "string", "place": "int", "n": "bigint"}

#: Seconds to wait for a count once its job has ended.
PATIENCE = 20


class Audit:
    """Counts of one run of one job; ``path`` is the table they are appended to."""

    def __init__(self, spark: SparkSession, path: str, job: str):
        self.spark, self.path, self.job = spark, path, job
        self.run = uuid.uuid4().hex
        self._steps: list[tuple[str, Observation | int]] = []

    def seen(self, df: DataFrame, step: str) -> DataFrame:
        """``df``, whose rows are counted when it is next computed."""
        observation = Observation(f"{self.job}.{step}.{self.run}.{len(self._steps)}")
        self._steps.append((step, observation))
        return df.observe(observation, F.count(F.lit(1)).alias("n"))

    def known(self, n: int, step: str) -> None:
        """A count that the job has anyway."""
        self._steps.append((step, n))

    def close(self) -> DataFrame:
        """Append the counts to the table, in the order of the steps; to be called after the job's actions."""
        now = datetime.now(UTC)
        rows = [
            (self.run, now, self.job, step, place, source if isinstance(source, int) else _count(source))
            for place, (step, source) in enumerate(self._steps)
        ]
        self.spark.createDataFrame(rows, ddl(AUDIT_TYPES)).coalesce(1).write.mode("append").parquet(self.path)
        return read_audit(self.spark, self.path).where(F.col("run") == self.run)


class _Nothing(Audit):
    """Counts nothing."""

    def __init__(self):
        pass

    def seen(self, df: DataFrame, step: str) -> DataFrame:
        return df

    def known(self, n: int, step: str) -> None:
        pass


#: For jobs that are run without an audit.
UNSEEN = _Nothing()


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(AUDIT_TYPES)).parquet(path)


def _count(observation: Observation) -> int | None:
    """The observed count; None if the job ended without it. Waiting has no limit of its own, hence the thread."""
    found: list[int] = []

    def wait() -> None:
        found.append(observation.get["n"])

    thread = threading.Thread(target=wait, daemon=True)
    thread.start()
    thread.join(PATIENCE)
    return found[0] if found else None

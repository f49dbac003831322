"""Weighted quantile summaries that merge, and the cuts taken from them.

A summary lists some of the values with bounds on the weight below each (``low``)
and up to and with each (``high``), and the value's own weight. Summaries of
parts merge into one of the whole without losing accuracy; only shortening one
to ``size`` values does: each time the rank of every value is known to
``1 / (size - 1)`` of the total weight less well. ``rank_error`` gives the
error a summary has. Values up to ``size`` in number are kept exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.session import ship_package

#: Values that a summary is shortened to, and summaries that one task merges.
SIZE = 2048
FAN_IN = 64

_SCHEMA = "feature int, part long, summary binary"


@dataclass(frozen=True)
class Summary:
    value: np.ndarray
    low: np.ndarray
    high: np.ndarray
    weight: np.ndarray

    @property
    def total(self) -> float:
        return float(self.high[-1]) if len(self.high) else 0.0

    @classmethod
    def of(cls, values: np.ndarray, weights: np.ndarray | None = None) -> Summary:
        """The exact summary of values; those without weight, and NaN, are left out."""
        weights = np.ones(len(values)) if weights is None else weights
        there = ~np.isnan(values) & (weights > 0)
        value, place = np.unique(values[there], return_inverse=True)
        weight = np.bincount(place, weights[there], len(value))
        high = np.cumsum(weight)
        return cls(value, high - weight, high, weight)

    def merge(self, other: Summary) -> Summary:
        value = np.union1d(self.value, other.value)
        parts = [s._bounds(value) for s in (self, other)]
        low, high, weight = (a + b for a, b in zip(*parts, strict=True))
        return Summary(value, low, high, weight)

    def _bounds(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """low, high and weight of any values: those between two of the list lie between their bounds."""
        after = np.searchsorted(self.value, values, "right")
        before = np.searchsorted(self.value, values, "left")
        there = after > before
        low = np.concatenate([[0.0], self.low + self.weight])[before]
        high = np.concatenate([self.high - self.weight, [self.total]])[after]
        at = before[there]
        low[there], high[there] = self.low[at], self.high[at]
        weight = np.zeros(len(values))
        weight[there] = self.weight[at]
        return low, high, weight

    def shortened(self, size: int = SIZE) -> Summary:
        """At most ``size`` values: the first, the last, and those nearest to evenly spaced ranks."""
        if len(self.value) <= size:
            return self
        keep = self._nearest(np.linspace(0, self.total, size)[1:-1])
        keep = np.unique(np.concatenate([[0], keep, [len(self.value) - 1]]))
        return Summary(self.value[keep], self.low[keep], self.high[keep], self.weight[keep])

    def _nearest(self, ranks: np.ndarray) -> np.ndarray:
        middle = (self.low + self.high) / 2
        right = np.clip(np.searchsorted(middle, ranks), 1, len(middle) - 1)
        return np.where(ranks - middle[right - 1] <= middle[right] - ranks, right - 1, right)

    def rank_error(self) -> float:
        """Most that the rank of any value of the data, as read from the summary, can be wrong, as a share of the weight."""
        if not self.total:
            return 0.0
        own = self.high - self.low - self.weight
        gap = self.high[1:] - self.low[:-1] - self.weight[1:] - self.weight[:-1]
        return float(max(own.max(initial=0), gap.max(initial=0))) / self.total

    def cuts(self, bins: int) -> np.ndarray:
        """Upper ends of ``bins`` ranges of about equal weight, the greatest value last; all values where there are no more."""
        if len(self.value) <= bins:
            return self.value
        inner = self._nearest(np.arange(1, bins) * (self.total / bins))
        return self.value[np.unique(np.concatenate([inner, [len(self.value) - 1]]))]

    def to_bytes(self) -> bytes:
        return np.stack([self.value, self.low, self.high, self.weight]).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Summary:
        return cls(*np.frombuffer(data, "<f8").reshape(4, -1))


class _Stack:
    """Summaries of one stream of values, merged pairwise like the digits of a binary counter: few shortenings each."""

    def __init__(self, size: int):
        self.size, self.levels = size, {}

    def add(self, summary: Summary, level: int = 0) -> None:
        while level in self.levels:
            summary = self.levels.pop(level).merge(summary).shortened(self.size)
            level += 1
        self.levels[level] = summary

    def whole(self) -> Summary:
        whole = Summary.of(np.zeros(0))
        for summary in self.levels.values():
            whole = whole.merge(summary)
        return whole.shortened(self.size)


def summaries(df: DataFrame, columns: list[Column], weight: Column | None = None, size: int = SIZE) -> dict[int, Summary]:
    """The summary of each column (by its place in the list) in one pass, merged in a tree of tasks.

    NULL and NaN are left out. At most ``size`` values a column come to the driver.
    """
    ship_package(df.sparkSession)
    weight, n = F.lit(1.0) if weight is None else weight, len(columns)
    named = df.select(*(c.cast("double").alias(f"v{i}") for i, c in enumerate(columns)), weight.cast("double").alias("weight"))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stacks = [_Stack(size) for _ in range(n)]
        for batch in batches:
            weights = batch.column(n).to_numpy(zero_copy_only=False)
            for stack, values in zip(stacks, batch.columns, strict=False):
                stack.add(Summary.of(values.to_numpy(zero_copy_only=False), weights).shortened(size))
        part = TaskContext.get().partitionId()
        yield pa.record_batch(
            [pa.array(range(len(stacks)), pa.int32()), pa.array([part] * len(stacks), pa.int64()),
             pa.array([s.whole().to_bytes() for s in stacks], pa.binary())],
            names=["feature", "part", "summary"],
        )

    def merge(table: pa.Table) -> pa.Table:
        stack = _Stack(size)
        for data in table["summary"].to_pylist():
            stack.add(Summary.from_bytes(data))
        return pa.table({
            "feature": table["feature"][:1], "part": pa.chunked_array([pa.array([table["part"][0].as_py() // FAN_IN], pa.int64())]),
            "summary": pa.chunked_array([pa.array([stack.whole().to_bytes()], pa.binary())]),
        })

    merged = named.mapInArrow(summarise, _SCHEMA)
    parts = named.rdd.getNumPartitions()
    while parts > 1:
        merged = merged.groupBy("feature", F.floor(F.col("part") / FAN_IN)).applyInArrow(merge, _SCHEMA)
        parts = -(-parts // FAN_IN)
    none = {i: Summary.of(np.zeros(0)) for i in range(n)}
    return none | {row.feature: Summary.from_bytes(row.summary) for row in merged.collect()}  # one row a column

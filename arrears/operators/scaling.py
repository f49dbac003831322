"""Standard scaling that leaves missing values missing."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.schemas import quoted


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, scale and count of each column, in one pass over the rows.

    NULL and NaN are left out. The scale is the population standard deviation,
    or 1 for a column that has a single value or a deviation too small to divide by.
    """
    stats = []
    for name in columns:
        value = _present(name)
        deviation = F.stddev_pop(value)
        constant = (F.min(value) == F.max(value)) | (deviation == 0)
        scale = F.when(constant, F.lit(1.0)).otherwise(deviation)
        stats.append(F.struct(
            F.lit(name).alias("feature"),
            F.avg(value).alias("mean"),
            scale.alias("scale"),
            F.count(value).alias("n"),
        ))
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


@dataclass(frozen=True)
class Scaler:
    """Fitted statistics, one entry per feature; ``None`` for a feature never seen."""

    mean: dict[str, float | None]
    scale: dict[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Scaler:
        rows = fit_scaler(df, columns).collect()  # one row per feature
        infinite = [row.feature for row in rows if not math.isfinite(row.mean or 0)]
        if infinite:
            raise ValueError(f"infinite values in {', '.join(infinite)}")
        return cls(
            mean={row.feature: row.mean for row in rows},
            scale={row.feature: row.scale for row in rows},
        )

    def scaled(self, name: str) -> Column:
        return (_present(name) - F.lit(self.mean[name])) / F.lit(self.scale[name])

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the features by their scaled values."""
        return df.withColumns({name: self.scaled(name) for name in self.mean})


def _present(name: str) -> Column:
    value = F.col(quoted(name)).cast("double")
    return F.when(~F.isnan(value), value)

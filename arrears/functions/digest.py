"""A digest of rows that does not depend on their order and can be added up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears.schemas import quoted


def digest_parts(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``n``, ``low`` and ``high``: the number of rows and the sums of two hashes of them.

    Parts of a table give the digest of the whole by adding up. Equal rows count
    each time. The hashes see a column's type and value, and whether it is NULL.
    """
    one = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("\x00")) for c in columns]
    hashes = [F.xxhash64(F.lit(seed), *one).cast("decimal(38,0)") for seed in (1, 2)]
    zero = F.lit(0).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.coalesce(F.sum(h), zero).alias(name) for name, h in zip(("low", "high"), hashes, strict=True)),
    ]


def digest_text() -> Column:
    """One text for ``n``, ``low`` and ``high``."""
    return F.concat_ws(":", F.col("n"), F.col("low"), F.col("high"))

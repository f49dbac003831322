"""Types of a feed's columns, found month by month in one pass.

A text is of one kind: empty, boolean, int, bigint, double, date, timestamp or
text. A set of kinds is a number with a bit for each, so sets of parts merge by
OR, in any order. The type of a set is the least one that holds all its kinds:

    int < bigint < double < string,  date < timestamp < string,  boolean < string

and every other mixture is text. A column without a value has no type (``void``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.delinquency import conform
from arrears.schemas import SNAPSHOT, quoted

# The kinds in the order of their bits, and the pattern of each.
KINDS = ["boolean", "int", "bigint", "double", "date", "timestamp", "string"]
_DOUBLE = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"

#: The type of a set of kinds: the first whose own set holds it.
MERGED = [
    ("boolean", ["boolean"]),
    ("int", ["int"]),
    ("bigint", ["int", "bigint"]),
    ("double", ["int", "bigint", "double"]),
    ("date", ["date"]),
    ("timestamp", ["date", "timestamp"]),
]


def _bit(kind: str) -> int:
    return 1 << KINDS.index(kind)


def kind_bit(text: Column) -> Column:
    """The bit of a text's kind; 0 for an empty one and NULL."""
    return _trimmed_bit(F.trim(text.cast("string")))


def _trimmed_bit(value: Column) -> Column:
    date = F.try_to_date(value, "yyyy-MM-dd")
    # Without point and exponent a number is whole; one too great for bigint is a double.
    number = (
        F.when(value.contains(".") | value.contains("e") | value.contains("E"), _bit("double"))
        .when(value.try_cast("int").isNotNull(), _bit("int"))
        .when(value.try_cast("bigint").isNotNull(), _bit("bigint"))
        .otherwise(_bit("double"))
    )
    # The patterns exclude each other; the most common kinds are tried first.
    return (
        F.when(value.isNull() | (value == ""), 0)
        .when(value.rlike(_DOUBLE), number)
        .when(value.rlike(_DATE) & date.isNotNull(), _bit("date"))
        .when(value.rlike(_TIMESTAMP) & value.try_cast("timestamp").isNotNull(), _bit("timestamp"))
        .when(F.length(value).between(4, 5) & F.lower(value).isin("true", "false"), _bit("boolean"))
        .otherwise(_bit("string"))
    )


def merged_type(kinds: Column) -> Column:
    """The least type that holds a set of kinds."""
    holds = lambda names: kinds.bitwiseAND(~reduce(int.__or__, map(_bit, names))) == 0
    found = F.when(kinds == 0, "void")
    for name, names in MERGED:
        found = found.when(holds(names), name)
    return found.otherwise("string")


def month_kinds(feed: DataFrame, date_format: str | None = None) -> DataFrame:
    """snapshot_date, column and its set of kinds: one aggregation of the feed, a row for each month and column.

    A cell becomes a row first: one expression judges all cells, which is little
    code that the JVM compiles. One for each column is more than it does.
    """
    names = [name for name in feed.columns if name != SNAPSHOT]
    cells = [F.struct(F.lit(name).alias("column"), F.trim(F.col(quoted(name)).cast("string")).alias("cell")) for name in names]
    month = conform(SNAPSHOT, "date", date_format).alias(SNAPSHOT)
    long = feed.select(month, F.inline(F.array(*cells)))
    return long.groupBy(SNAPSHOT, "column").agg(F.bit_or(_trimmed_bit(F.col("cell"))).alias("kinds"))


def month_types(kinds: DataFrame) -> DataFrame:
    """Type of each month and column, the type that holds all months, and whether the month's differs from it (drift).

    A month without a value of the column does not drift.
    """
    whole = kinds.groupBy("column").agg(F.bit_or("kinds").alias("all_kinds"))
    own, merged = merged_type(F.col("kinds")), merged_type(F.col("all_kinds"))
    # A row for each column of the feed.
    return kinds.join(F.broadcast(whole), "column").select(
        SNAPSHOT, "column", own.alias("type"), merged.alias("merged_type"), ((own != merged) & (F.col("kinds") != 0)).alias("drift")
    )

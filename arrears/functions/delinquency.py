"""Delinquency arithmetic on one loan snapshot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears.schemas import quoted

# The default label is 30 days past due at 6 months on book.
LABEL_DPD = 30
LABEL_MOB = 6

#: Counts of days and instalments stop at the ends of their type instead of wrapping round.
_INT = (-(2**31), 2**31 - 1)


def conform(column: str, kind: str, date_format: str | None = None) -> Column:
    """Cast that gives NULL, not an error, for a value outside the type.

    Numbers pass through double, so the text ``6.0`` is a valid integer.
    """
    value = F.col(quoted(column))
    if kind == "date" and date_format:
        return F.try_to_date(value, date_format)
    if kind in ("int", "float"):
        value = value.try_cast("double")
    return value.try_cast(kind)


def installments_missed(overdue: Column, due: Column) -> Column:
    """Number of instalments the overdue amount stands for, rounded up, at most the greatest integer."""
    return _bounded(F.ceil(F.try_divide(overdue, due)))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Month of the oldest unpaid instalment; NULL when none is missed, or before the first date there is."""
    return F.when(missed > 0, F.try_add(snapshot, F.make_ym_interval(F.lit(0), -missed)))


def days_past_due(overdue: Column, snapshot: Column, missed: Column, first_missed: Column) -> Column:
    """Days since the first missed date; 0 without overdue money.

    NULL when money is overdue but no missed month is known. A first missed
    date before the first date there is counts as the greatest integer, as does
    any greater number of days: such a loan must not look as if it were paid.
    """
    days = _bounded(F.unix_date(snapshot).cast("bigint") - F.unix_date(first_missed))
    longest = F.when(snapshot.isNotNull() & (missed > 0), F.lit(_INT[1]))
    return F.when(overdue > 0, F.coalesce(days, longest)).otherwise(F.lit(0))


def _bounded(whole: Column) -> Column:
    # least and greatest skip NULL, which must stay.
    return F.when(whole.isNotNull(), F.least(F.greatest(whole, F.lit(_INT[0])), F.lit(_INT[1])).cast("int"))


def is_bad(dpd: Column, threshold: int = LABEL_DPD) -> Column:
    """1 from ``threshold`` days past due, else 0; an unknown dpd is 0."""
    return F.when(dpd >= threshold, F.lit(1)).otherwise(F.lit(0))


def label_definition(dpd: int = LABEL_DPD, mob: int = LABEL_MOB) -> str:
    return f"{dpd}dpd_{mob}mob"

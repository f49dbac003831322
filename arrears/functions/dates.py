"""Month calendar: spines, training windows and date-based names."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Training windows in months, version prefix and file suffix of a model.
TRAIN_TEST_MONTHS = 12
OOT_MONTHS = 2
VERSION_PREFIX = "credit_model_"
MODEL_SUFFIX = ".pkl"


def to_day(value: date | str) -> date:
    """Date of a ``yyyy-mm-dd`` text or of a point in time; dates pass through."""
    if isinstance(value, datetime):
        return value.date()
    return date.fromisoformat(value) if isinstance(value, str) else value


def add_months(day: date, months: int) -> date:
    """Shift by whole months; a day past the month's end becomes its last day."""
    year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


def month_list(start: date | str, end: date | str) -> list[date]:
    """First days of all months from the start's month up to ``end``."""
    first, last = to_day(start).replace(day=1), to_day(end)
    span = (last.year - first.year) * 12 + last.month - first.month
    return [add_months(first, i) for i in range(span + 1)]


def month_spine(start: Column, end: Column) -> Column:
    """Array column with the same months as :func:`month_list`."""
    return F.sequence(F.trunc(start, "MM"), end, F.expr("interval 1 month"))


@dataclass(frozen=True)
class TrainingCalendar:
    """Inclusive windows that belong to one training date."""

    train_date: date
    train_test_start: date
    train_test_end: date
    oot_start: date
    oot_end: date

    @classmethod
    def of(
        cls,
        train_date: date | str,
        train_test_months: int = TRAIN_TEST_MONTHS,
        oot_months: int = OOT_MONTHS,
    ) -> TrainingCalendar:
        day = to_day(train_date)
        oot_start = add_months(day, -oot_months)
        return cls(
            train_date=day,
            train_test_start=add_months(oot_start, -train_test_months),
            train_test_end=oot_start - timedelta(days=1),
            oot_start=oot_start,
            oot_end=day - timedelta(days=1),
        )


def calendar_columns(
    train_date: Column,
    train_test_months: int = TRAIN_TEST_MONTHS,
    oot_months: int = OOT_MONTHS,
) -> dict[str, Column]:
    """:class:`TrainingCalendar` for a column of training dates."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "train_date": train_date,
        "oot_end": F.date_sub(train_date, 1),
        "oot_start": oot_start,
        "train_test_end": F.date_sub(oot_start, 1),
        "train_test_start": F.add_months(oot_start, -train_test_months),
    }


def date_key(day: Column) -> Column:
    """``2023-01-01`` as ``2023_01_01``."""
    return F.date_format(day, "yyyy_MM_dd")


def version_column(day: Column) -> Column:
    return F.concat(F.lit(VERSION_PREFIX), date_key(day))


def model_version(train_date: date | str) -> str:
    return VERSION_PREFIX + to_day(train_date).strftime("%Y_%m_%d")


def version_of(model_name: str) -> str:
    """Version a model name stands for, with or without the file suffix."""
    return model_name.removesuffix(MODEL_SUFFIX)

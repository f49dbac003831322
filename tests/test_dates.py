from datetime import date

import pytest
from pyspark.sql import functions as F

from arrears.functions.dates import (
    TrainingCalendar,
    add_months,
    calendar_columns,
    model_version,
    month_list,
    month_spine,
    version_of,
)


def test_month_list():
    months = month_list("2023-01-01", "2024-12-01")
    assert len(months) == 24 and months[0] == date(2023, 1, 1) and months[-1] == date(2024, 12, 1)
    assert month_list("2023-01-17", "2023-03-31") == [date(2023, m, 1) for m in (1, 2, 3)]
    assert month_list("2023-05-01", "2023-04-30") == []


def test_month_spine_equals_month_list(spark):
    spans = [("2023-01-01", "2024-12-01"), ("2023-01-17", "2023-03-31"), ("2022-12-31", "2023-01-01")]
    df = spark.createDataFrame(spans, "a string, b string").select(
        "a", "b", month_spine(F.col("a").cast("date"), F.col("b").cast("date")).alias("m")
    )
    for row in df.collect():
        assert row.m == month_list(row.a, row.b)


def test_training_calendar():
    cal = TrainingCalendar.of("2024-09-01")
    assert (cal.train_test_start, cal.train_test_end) == (date(2023, 7, 1), date(2024, 6, 30))
    assert (cal.oot_start, cal.oot_end) == (date(2024, 7, 1), date(2024, 8, 31))


@pytest.mark.parametrize("day", ["2024-09-01", "2024-04-30", "2024-12-31", "2023-01-15"])
def test_calendar_columns_equal_calendar(spark, day):
    cal = TrainingCalendar.of(day)
    columns = calendar_columns(F.lit(cal.train_date))
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    assert row.asDict() == {name: getattr(cal, name) for name in columns}


def test_add_months_clamps():
    assert add_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert add_months(date(2023, 1, 1), -13) == date(2021, 12, 1)


def test_model_names():
    assert model_version("2024-09-01") == "credit_model_2024_09_01"
    assert version_of("credit_model_2024_09_01.pkl") == version_of("credit_model_2024_09_01")

"""Every query with oracle SQL gives the same rows, types and values as DuckDB."""

import math

import pandas as pd
import pytest

import __spark_entry__ as driver

SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN",
}


def canonical(frame):
    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA:
            return ""
        if isinstance(value, float) and math.isnan(value):
            return ""
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        return value if isinstance(value, str) else repr(float(value))

    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_oracle(spark, duck, sf_dir, name):
    sql = driver.oracle_sql()[name]
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    kinds = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: SPARK_TYPES[kind] for c, kind in df.dtypes} == kinds
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert slow not in plan
    got, want = df.toPandas()[columns], duck.execute(sql).df()[columns]
    assert len(got) > 0
    assert canonical(got) == canonical(want)


def test_bad_rates_come_in_month_order(spark, sf_dir):
    mobs = [row.mob for row in driver.queries()["bad_rate_by_mob"](spark, sf_dir).collect()]
    assert mobs == sorted(mobs)


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_counts_every_labelled_row(spark, duck):
    totals = driver.entry(spark).groupBy().sum("n", "positives").first()
    rows = duck.execute(f"SELECT count(*), sum(label) FROM ({driver.oracle_sql()['gold_label']})").fetchone()
    assert tuple(totals) == rows and 0 < totals[1] < totals[0]

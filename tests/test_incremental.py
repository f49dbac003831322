"""Refresh of changed months, types of months, and counts of running jobs."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from arrears.functions.digest import digest_parts, digest_text
from arrears.layout import Layout
from arrears.operators.types import kind_bit, merged_type, month_kinds, month_types
from arrears.plans import datamart, incremental, scoring
from arrears.plans.audit import Audit, read_audit
from arrears.schemas import LOAN_TYPES
from arrears.sources.tables import read_csv
from conftest import rows

MONTHS = ["2023-01-01", "2023-02-01", "2023-03-01"]


def line(i, month, inst=6, due=100, overdue=0):
    return ",".join(map(str, (f"L{i}", i, "2022-07-01", 10, inst, 1000, due, 0, overdue, 400, month)))


def write(path, name, lines):
    Path(path).mkdir(parents=True, exist_ok=True)
    (Path(path) / name).write_text("\n".join([",".join(LOAN_TYPES), *lines]) + "\n")


@pytest.fixture()
def mart(tmp_path):
    feed = str(tmp_path / "feed")
    write(feed, "a.csv", [line(i, m) for m in MONTHS[:2] for i in range(20)])
    return feed, Layout(str(tmp_path / "mart"))


def files(layout):
    return {str(f): f.stat().st_mtime_ns for f in Path(layout.mart).rglob("part-*") if "built" not in f.parts}


def test_only_changed_months_are_rebuilt(spark, mart):
    feed, layout = mart
    first = incremental.refresh(spark, feed, layout, MONTHS)
    assert all(len(first.months[layer]) == 3 for layer in incremental.LAYERS)
    assert incremental.refresh(spark, feed, layout, MONTHS).months == {layer: [] for layer in incremental.LAYERS}
    before = files(layout)
    write(feed, "late.csv", [line(99, MONTHS[1])])
    again = incremental.refresh(spark, feed, layout, MONTHS)
    assert again.months == {layer: [date(2023, 2, 1)] for layer in incremental.LAYERS}
    after = files(layout)
    untouched = {f for f in before if "2023-02-01" not in f}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    counts = datamart.layer_counts(silver=datamart.read_silver(spark, layout.silver), gold=datamart.read_labels(spark, layout.labels))
    assert {(r.layer, r.snapshot_date.month): r.n for r in counts.collect()} == {
        ("silver", 1): 20, ("silver", 2): 21, ("gold", 1): 20, ("gold", 2): 21}


def test_a_run_that_died_is_caught_up(spark, mart, monkeypatch):
    feed, layout = mart
    plain = datamart.build_silver

    def dies(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(datamart, "build_silver", dies)
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, feed, layout, MONTHS)
    monkeypatch.setattr(datamart, "build_silver", plain)
    again = incremental.refresh(spark, feed, layout, MONTHS)
    assert [len(again.months[layer]) for layer in incremental.LAYERS] == [0, 3, 3]


def test_removed_rows_and_another_label_definition(spark, mart):
    feed, layout = mart
    incremental.refresh(spark, feed, layout, MONTHS)
    write(feed, "a.csv", [line(i, MONTHS[0]) for i in range(20)])
    gone = incremental.refresh(spark, feed, layout, MONTHS)
    assert gone.months["gold"] == [date(2023, 2, 1)]
    assert datamart.read_labels(spark, layout.labels).where("snapshot_date = '2023-02-01'").count() == 0
    other = incremental.refresh(spark, feed, layout, MONTHS, dpd=60)
    assert [len(other.months[layer]) for layer in incremental.LAYERS] == [0, 0, 3]


def test_digest_counts_copies_in_any_order_and_tells_null_from_empty(spark):
    def digest(data):
        df = spark.createDataFrame(data, "a string, `b.c` int").repartition(3)
        return df.agg(*digest_parts(df.columns)).select(digest_text()).first()[0]

    one = [("x", 1), ("y", 2), (None, 3)]
    assert digest(one) == digest(one[::-1])
    others = [one + one[:1], [("x", 1), ("y", 2), ("", 3)], [("x", 2), ("y", 1), (None, 3)], one[:2], []]
    assert len({digest(o) for o in [one, *others]}) == 6
    parts = [spark.createDataFrame(p, "a string, `b.c` int").agg(*digest_parts(["a", "b.c"])).first() for p in (one[:1], one[1:])]
    assert digest(one) == ":".join(str(a + b) for a, b in zip(*parts))


@pytest.mark.parametrize(("values", "expected"), [
    (["1", "-2", " 3 "], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5"], "double"), (["1e5", ".5", "7."], "double"),
    (["true", "FALSE"], "boolean"), (["2023-01-01", "2023-01-01 10:00:00"], "timestamp"), (["2023-02-30"], "string"),
    (["true", "1"], "string"), (["2023-01-01", "1"], "string"), (["", None], "void"), (["007", ""], "int"),
    (["99999999999999999999"], "double"), (["1.2.3"], "string"), ([], "void"), (["x" * 100_000], "string"),
])
def test_merged_types(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.agg(merged_type(F.coalesce(F.bit_or(kind_bit(F.col("v"))), F.lit(0))).alias("t")).first().t
    assert got == expected


def test_types_of_each_month(spark, tmp_path):
    path = str(tmp_path / "feed")
    write(path, "a.csv", [line(i, MONTHS[0]) for i in range(5)] + [line(i, MONTHS[1], due="12.5") for i in range(5)])
    write(path, "b.csv", [line(9, MONTHS[2], due="n/a"), line(8, MONTHS[2], due="")])
    found = month_types(month_kinds(read_csv(spark, path)))
    own = sorted((r.snapshot_date.month, r.type, r.merged_type, r.drift) for r in found.where("column = 'due_amt'").collect())
    assert own == [(1, "int", "string", True), (2, "double", "string", True), (3, "string", "string", False)]
    assert found.where("drift AND column <> 'due_amt'").count() == 0
    assert found.count() == 3 * (len(LOAN_TYPES) - 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") <= 2


def test_counts_of_running_jobs(spark, mart, tmp_path):
    feed, layout = mart
    path = str(tmp_path / "audit")
    audit = Audit(spark, path, "bronze")
    datamart.build_bronze(spark, feed, layout.bronze, MONTHS[:1], audit=audit)
    assert rows(audit.close(), "step", "n") == [("bronze months", 20), ("feed loaded", 40)]
    other = Audit(spark, path, "silver")
    datamart.build_silver(spark, layout.bronze, layout.silver, MONTHS[:1], audit=other)
    other.known(7, "by hand")
    assert rows(other.close(), "job", "step", "place", "n") == [("silver", "bronze loaded", 0, 20), ("silver", "by hand", 1, 7)]
    assert read_audit(spark, path).count() == 4
    assert scoring.UNSEEN.seen(other.close(), "x") is not None


def test_a_count_that_never_came_is_null(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("arrears.plans.audit.PATIENCE", 1)
    audit = Audit(spark, str(tmp_path), "job")
    audit.seen(spark.range(3), "never computed")
    assert audit.close().first().n is None


def test_month_kinds_judge_all_cells_by_one_expression(spark):
    feed = spark.createDataFrame(
        [("2023-01-01", " 5 ", "9" * 30, "TRUE", None), ("2023-01-01", "-7", "1e5", "x", ""), (None, "2.", "+3000000000", "Off", "2023-02-30")],
        "snapshot_date string, `a.b` string, c string, d string, e string",
    )
    found = month_kinds(feed)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp") == 1
    got = {(str(r.snapshot_date), r.column): r.kinds for r in found.collect()}
    bit = {kind: 1 << i for i, kind in enumerate(["boolean", "int", "bigint", "double", "date", "timestamp", "string"])}
    assert got == {
        ("2023-01-01", "a.b"): bit["int"], ("2023-01-01", "c"): bit["double"], ("2023-01-01", "d"): bit["boolean"] | bit["string"],
        ("2023-01-01", "e"): 0, ("None", "a.b"): bit["double"], ("None", "c"): bit["bigint"], ("None", "d"): bit["string"], ("None", "e"): bit["string"],
    }

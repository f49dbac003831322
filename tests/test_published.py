"""Published tables: readers see all months of a run or none."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from arrears.schemas import LABEL_TYPES
from arrears.sources import published
from arrears.sources.published import manifest, read_published, replace_months, stage_months, superseded_runs
from conftest import rows

JAN, FEB, MAR = (date(2023, m, 1) for m in (1, 2, 3))


def labels(spark, *counts):
    data = [(f"L{i}", str(i), 0, "d", month) for month, n in counts for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} {k}" for c, k in LABEL_TYPES.items()))


def counts(spark, path, **options):
    found = read_published(spark, path, LABEL_TYPES, **options)
    assert found.columns == list(LABEL_TYPES)
    return dict(map(tuple, found.groupBy("snapshot_date").count().collect()))


def test_full_and_emptied_months_change_together(spark, tmp_path):
    path = str(tmp_path / "t")
    assert manifest(spark, path) == (0, {}) and counts(spark, path) == {}
    assert replace_months(labels(spark, (JAN, 3), (FEB, 4)), path, [JAN, FEB, MAR]) == 1
    assert counts(spark, path) == {JAN: 3, FEB: 4}
    before = read_published(spark, path, LABEL_TYPES)
    assert replace_months(labels(spark, (MAR, 5), (FEB, 1)), path, ["2023-01-01", FEB, MAR]) == 2
    assert counts(spark, path) == {FEB: 1, MAR: 5} and set(manifest(spark, path)[1]) == {JAN, FEB, MAR}
    assert counts(spark, path, months=[JAN, MAR]) == {MAR: 5} and counts(spark, path, version=1) == {JAN: 3, FEB: 4}
    # A reader that began before goes on with the months it chose.
    assert before.count() == 7 and len(superseded_runs(spark, path)) == 1


def test_a_run_that_dies_before_it_publishes_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_months(labels(spark, (JAN, 3), (FEB, 4)), path, [JAN, FEB])
    whole = rows(read_published(spark, path, LABEL_TYPES))

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(published, "publish", dies)
    with pytest.raises(RuntimeError):
        replace_months(labels(spark, (JAN, 9)), path, [JAN, FEB])
    monkeypatch.undo()
    assert rows(read_published(spark, path, LABEL_TYPES)) == whole
    replace_months(labels(spark, (JAN, 9)), path, [JAN, FEB])
    assert counts(spark, path) == {JAN: 9}


def test_two_runs_cannot_publish_the_same_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_months(labels(spark, (JAN, 3)), path, [JAN])
    run, full = stage_months(labels(spark, (JAN, 4)), path)
    stale = manifest(spark, path)
    replace_months(labels(spark, (JAN, 5)), path, [JAN])
    monkeypatch.setattr(published, "manifest", lambda *args: stale)
    with pytest.raises(Exception, match="already exists"):
        published.publish(spark, path, run, [JAN], full)
    monkeypatch.undo()
    assert counts(spark, path) == {JAN: 5}


def test_rows_of_other_months_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        replace_months(labels(spark, (JAN, 3), (FEB, 1)), path, [JAN])
    assert manifest(spark, path) == (0, {})


def test_only_the_wanted_months_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_months(labels(spark, (JAN, 3), (FEB, 1)), path, [JAN, FEB])
    found = read_published(spark, path, LABEL_TYPES, [FEB])
    assert all("snapshot_date=2023-02-01" in f for f in found.inputFiles())
    assert found.where(F.col("snapshot_date") == F.lit(FEB)).count() == 1


def test_training_rows_of_a_run_that_dies_are_not_seen(spark, tmp_path, monkeypatch):
    from arrears.functions.dates import TrainingCalendar
    from arrears.plans import training

    cal, bank = TrainingCalendar.of("2023-06-01"), str(tmp_path)
    features = spark.createDataFrame([("0", JAN, 1.0)], "Customer_ID string, snapshot_date date, fe_1 double")
    training.build_training_rows(spark, labels(spark, (JAN, 3)), features, cal, bank)
    whole = training.build_training_set(spark, cal, bank).count()

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(training, "unmatched_rows", dies)
    with pytest.raises(RuntimeError):
        training.build_training_rows(spark, labels(spark, (JAN, 9)), features, cal, bank)
    assert training.build_training_set(spark, cal, bank).count() == whole == 3
    monkeypatch.undo()
    training.build_training_rows(spark, labels(spark, (JAN, 9)), features, cal, bank)
    assert training.build_training_set(spark, cal, bank).count() == 9
    with pytest.raises(LookupError):
        training.build_training_set(spark, TrainingCalendar.of("2020-01-01"), bank)

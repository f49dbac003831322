"""Bronze, silver and gold builds on files."""

import uuid
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from arrears import __main__ as command
from arrears.plans import datamart
from arrears.plans.vintage import vintage_report
from arrears.schemas import LABEL_TYPES, LOAN_TYPES, SILVER_TYPES
from arrears.sources.sinks import overwrite_months
from arrears.sources.tables import in_months, read_csv, read_features, read_months
from conftest import rows

MONTHS = ["2023-01-01", "2023-02-01", "2023-03-01"]
HEADER = ",".join(LOAN_TYPES) + ",branch"


def feed(path, data):
    path.mkdir(parents=True, exist_ok=True)
    lines = [HEADER] + [",".join(map(str, line)) for line in data]
    (path / "loans.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def loan(i, month, inst=6, due=100, overdue=0, branch="north"):
    return (f"L{i}", i, "2022-07-01", 10, inst, 1000, due, 0, overdue, 400, month, branch)


DATA = (
    [loan(i, "2023-01-01", overdue=100 * (i % 3)) for i in range(30)]
    + [loan(i, "2023-02-01", inst=7) for i in range(20)]
    + [loan(99, "2023-04-01"), loan(98, "not a date"), loan("007", "2023-01-01", branch='"a, b"')]
)


@pytest.fixture()
def mart(tmp_path):
    raw = feed(tmp_path / "raw", DATA)
    return raw, *(str(tmp_path / name) for name in ("bronze", "silver", "gold"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layers(spark, mart):
    raw, bronze, silver, gold = mart
    copied = datamart.build_bronze(spark, raw, bronze, MONTHS)
    source = read_csv(spark, raw).where(F.col("snapshot_date").isin(MONTHS))
    assert copied.columns == source.columns
    assert rows(copied.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))) == rows(source)
    assert copied.where("branch = 'a, b' AND Customer_ID = '007'").count() == 1

    typed = datamart.build_silver(spark, bronze, silver, MONTHS)
    assert dict(typed.dtypes) == SILVER_TYPES | {"branch": "string"} and typed.count() == 51
    assert typed.where("loan_id = 'L2'").first().dpd == 61

    labels = datamart.build_labels(spark, silver, gold, MONTHS)
    assert dict(labels.dtypes) == LABEL_TYPES
    assert labels.groupBy().agg(F.count("*"), F.sum("label")).first() == (31, 20)

    counts = datamart.layer_counts(bronze=copied, silver=typed, gold=labels)
    assert rows(counts) == [
        ("bronze", date(2023, 1, 1), 31, None), ("bronze", date(2023, 2, 1), 20, None),
        ("gold", date(2023, 1, 1), 31, None),
        ("silver", date(2023, 1, 1), 31, 0), ("silver", date(2023, 2, 1), 20, 0),
    ]


def test_a_month_without_rows_is_there_but_empty(spark, mart):
    raw, bronze, silver, gold = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    datamart.build_silver(spark, bronze, silver, MONTHS)
    datamart.build_labels(spark, silver, gold, MONTHS)
    for layer in (bronze, silver, gold):
        assert sorted(p.name[-10:] for p in Path(layer).glob("snapshot_date=*")) == MONTHS
    assert datamart.read_bronze(spark, bronze, ["2023-03-01"]).count() == 0
    empty = datamart.read_labels(spark, gold).where(in_months(["2023-02-01"]))
    assert empty.count() == 0 and dict(empty.dtypes) == LABEL_TYPES


def test_months_with_no_rows_at_all(spark, mart):
    raw, bronze, silver, _ = mart
    assert datamart.build_bronze(spark, raw, bronze, ["2030-01-01"]).count() == 0
    assert datamart.build_silver(spark, bronze, silver, ["2030-01-01"]).count() == 0


def test_rerun_changes_nothing(spark, mart):
    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    before = rows(datamart.build_silver(spark, bronze, silver, MONTHS))
    datamart.build_bronze(spark, raw, bronze, MONTHS[:1])
    datamart.build_silver(spark, bronze, silver, MONTHS[:1])
    assert rows(datamart.read_silver(spark, silver)) == before


def test_rerun_clears_a_month_that_lost_its_rows(spark, mart, tmp_path):
    raw, bronze, _, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    later = feed(tmp_path / "later", [loan(1, "2023-01-01")])
    datamart.build_bronze(spark, later, bronze, ["2023-01-01", "2023-02-01"])
    counts = datamart.read_bronze(spark, bronze).groupBy("snapshot_date").count()
    assert rows(counts) == [(date(2023, 1, 1), 1)]


def test_bronze_reads_only_the_months_asked_for(spark, mart):
    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    datamart.build_silver(spark, bronze, silver, MONTHS)
    wanted = datamart.read_bronze(spark, bronze, MONTHS[:1])
    pruned = datamart.read_silver(spark, silver).where(in_months(MONTHS[:1])).select("loan_id", "dpd")
    for plan in (plan_of(wanted), plan_of(pruned)):
        assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "2023-01-01" in plan
    assert "ReadSchema: struct<loan_id:string,dpd:int>" in plan_of(pruned)


def test_a_large_month_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 8).selectExpr(
        "uuid() AS loan_id", "if(id % 3 = 0, date'2023-01-01', add_months(date'2020-01-01', int(id % 24)))"
        " AS snapshot_date",
    )
    path = str(tmp_path / "table")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        overwrite_months(df, path, [])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list(Path(path).glob("snapshot_date=2023-01-01/part-*"))
    cold = list(Path(path).glob("snapshot_date=2020-02-01/part-*"))
    assert len(hot) >= 5 and len(cold) <= 4
    assert spark.read.parquet(path).count() == 400_000


def test_silver_build_does_not_shuffle(spark, mart):
    from arrears.operators.silver import silver_loans

    raw, bronze, _, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    assert "Exchange" not in plan_of(silver_loans(datamart.read_bronze(spark, bronze, MONTHS)))


def test_inferred_feed_gives_the_same_silver(spark, mart, tmp_path):
    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    want = rows(datamart.build_silver(spark, bronze, silver, MONTHS).where("loan_id <> 'L007'"))
    bronze2, silver2 = str(tmp_path / "b2"), str(tmp_path / "s2")
    datamart.build_bronze(spark, raw, bronze2, MONTHS, infer=True)
    assert rows(datamart.build_silver(spark, bronze2, silver2, MONTHS).where("loan_id <> 'L007'")) == want


def test_inferred_types_fill_other_numbers_too(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    (tmp_path / "raw").mkdir()
    lines = [",".join(LOAN_TYPES) + ",visits"]
    lines += [",".join(map(str, loan(i, "2023-01-01")[:-1])) + f",{i or ''}" for i in range(3)]
    (tmp_path / "raw" / "l.csv").write_text("\n".join(lines) + "\n")
    datamart.build_bronze(spark, raw, bronze, MONTHS[:1])
    for infer, want in ((True, [0, 1, 2]), (False, [None, "1", "2"])):
        datamart.build_silver(spark, bronze, str(tmp_path / f"s{infer}"), MONTHS[:1], infer=infer)
        table = spark.read.parquet(str(tmp_path / f"s{infer}"))
        assert [row.visits for row in table.orderBy("loan_id").collect()] == want


def test_parquet_bronze_gives_the_same_silver(spark, mart, tmp_path):
    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    want = rows(datamart.build_silver(spark, bronze, silver, MONTHS))
    b2, s2 = str(tmp_path / "b2"), str(tmp_path / "s2")
    datamart.build_bronze(spark, raw, b2, MONTHS, fmt="parquet")
    assert rows(datamart.build_silver(spark, b2, s2, MONTHS, fmt="parquet")) == want
    table = datamart.read_bronze(spark, b2, MONTHS, fmt="parquet")
    assert table.where("Customer_ID = '007'").first().branch == "a, b"


def test_swapped_header_fails_instead_of_mixing_columns(spark, tmp_path):
    for name, header, line in (("a", "x,y", "1,2"), ("b", "y,x", "2,1")):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{line}\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        read_csv(spark, str(tmp_path)).collect()


def test_the_header_is_found_without_a_task_for_each_file(spark, tmp_path):
    for i in range(50):
        folder = tmp_path / "feed" / f"snapshot_date=2023-{i % 2 + 1:02d}-01"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.csv").write_text(f"x,a`b\n{i},007\n")
    context = spark.sparkContext
    group = uuid.uuid4().hex
    context.setJobGroup(group, "")
    try:
        df = read_csv(spark, str(tmp_path / "feed"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    sizes = [info.numTasks for info in map(tracker.getStageInfo, stages) if info is not None]
    assert sizes and max(sizes) < 32
    assert df.dtypes == [("x", "string"), ("a`b", "string"), ("snapshot_date", "date")]
    assert df.count() == 50 and {r[1] for r in df.collect()} == {"007"}


@pytest.mark.parametrize("files", [
    {"a.csv": "\n  \na,b\n1,2\n", "b.csv": ""},
    {"a.csv": '"a b","c,d",e.f\n1,"x""y",\n'},
    {"b=1/a.csv": "a,b\n1,2\n", "b=2/a.csv": "a,b\n3,4\n"},
    {"value=1/a.csv": "a,b\n1,2\n"},
    {"a.csv": " a , b\r\n 1 ,2\r\n"},
    {"a.csv": ""},
])
def test_feeds_have_the_columns_that_spark_finds(spark, tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    own = spark.read.options(header=True, enforceSchema=False).csv(str(tmp_path))
    got = read_csv(spark, str(tmp_path))
    assert got.dtypes == own.dtypes and rows(got) == rows(own)


def test_months_beyond_the_open_files_are_written_too(spark, tmp_path, monkeypatch):
    from arrears.sources import sinks

    monkeypatch.setattr(sinks, "OPEN_FILES", 2)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    df = spark.range(0, 700, 1, 1).selectExpr("CAST(id AS STRING) AS loan_id", "add_months(DATE'2023-01-01', CAST(id % 7 AS INT)) AS snapshot_date")
    months = [date(2023, m, 1) for m in range(1, 8)]
    overwrite_months(df, str(tmp_path / "t"), months, "csv", rebalance=False)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    back = datamart.read_bronze(spark, str(tmp_path / "t"), months)
    assert rows(back.select("loan_id", "snapshot_date")) == rows(df)
    assert len(list((tmp_path / "t").glob("*/part-*"))) == 7


def test_silver_is_written_without_dictionaries(spark, mart):
    import pyarrow.parquet as pq

    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    datamart.build_silver(spark, bronze, silver, MONTHS)
    chunks = [
        group.column(i)
        for file in Path(silver).rglob("part-*.parquet")
        for meta in [pq.ParquetFile(file).metadata]
        for group in map(meta.row_group, range(meta.num_row_groups))
        for i in range(group.num_columns)
    ]
    assert chunks and not any(chunk.has_dictionary_page for chunk in chunks)


def test_feature_feed(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "snapshot_date,Customer_ID,fe_1,note,fe_2\n2023-01-01,007,1,hello,2.5\n2023-02-01,8,,x,bad\n"
    )
    df = read_features(spark, str(tmp_path / "f.csv"))
    assert df.dtypes == [("snapshot_date", "date"), ("Customer_ID", "string"), ("fe_1", "double"),
                         ("note", "string"), ("fe_2", "double")]
    df.write.parquet(str(tmp_path / "parquet"))
    assert rows(read_features(spark, str(tmp_path / "parquet"), "parquet")) == rows(df)
    assert rows(df) == [
        (date(2023, 1, 1), "007", 1.0, "hello", 2.5), (date(2023, 2, 1), "8", None, "x", None)
    ]


def test_vintage_report(spark, mart):
    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    datamart.build_silver(spark, bronze, silver, MONTHS)
    report = vintage_report(spark, silver, "2023-01-01")
    assert rows(report) == [(6, 20 / 31, 31), (7, 0.0, 20)]
    assert vintage_report(spark, silver, "2022-07-01").count() == 0


def test_dates_do_not_depend_on_the_time_zone(spark, mart):
    raw, bronze, _, _ = mart
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert datamart.build_bronze(spark, raw, bronze, MONTHS).count() == 51
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_read_months_unions_all_months(spark, tmp_path):
    path = str(tmp_path / uuid.uuid4().hex)
    for month, n in (("2023-01-01", 2), ("2023-02-01", 3)):
        df = spark.range(n).selectExpr("cast(id AS string) AS loan_id", f"date'{month}' AS snapshot_date")
        overwrite_months(df, path, [month])
    table = read_months(spark, path, {"loan_id": "string", "snapshot_date": "date"})
    assert table.count() == 5


def test_silver_keeps_columns_the_schema_does_not_name(spark, mart):
    raw, bronze, silver, _ = mart
    datamart.build_bronze(spark, raw, bronze, MONTHS)
    table = datamart.build_silver(spark, bronze, silver, MONTHS)
    assert table.columns == [*SILVER_TYPES, "branch"]
    assert {r.branch for r in datamart.read_silver(spark, silver).collect()} == {"north", "a, b"}
    assert datamart.read_silver(spark, silver, others=False).columns == list(SILVER_TYPES)


def test_a_point_in_time_is_its_day(spark, tmp_path):
    df = spark.sql("SELECT 1 AS x, date'2023-01-01' AS snapshot_date")
    overwrite_months(df, str(tmp_path / "t"), [datetime(2023, 1, 1), datetime(2023, 2, 1)])
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == [
        "snapshot_date=2023-01-01", "snapshot_date=2023-02-01"]


def test_reports_are_written_whole(spark, tmp_path, monkeypatch, capsys):
    """A loan book of 360 months on book, and the rows of each layer."""
    data = [loan(i, "2023-01-01", inst=i) for i in range(360)]
    raw, mart = feed(tmp_path / "raw", data), str(tmp_path / "mart")
    monkeypatch.setattr(command, "build_session", lambda: spark)
    command.main(["--mart", mart, "backfill", "--start", "2023-01-01", "--end", "2023-01-01", "--loans", raw, "--infer"])
    command.main(["--mart", mart, "vintage", "--before", "2024-01-01", "--out", str(tmp_path / "curve")])
    assert spark.read.parquet(str(tmp_path / "curve")).select("mob").distinct().count() == 360
    command.main(["--mart", mart, "counts"])
    counts = spark.read.parquet(f"{mart}/reports/counts")
    assert rows(counts, "layer", "n") == [("bronze", 360), ("gold", 1), ("silver", 360)]
    assert "written to" in capsys.readouterr().out


def test_bronze_need_not_be_rebalanced(spark, mart):
    raw, bronze, _, _ = mart
    plain = datamart.build_bronze(spark, raw, bronze, MONTHS, rebalance=False)
    assert plain.count() == 51


def test_bronze_is_written_without_a_shuffle_as_gzip(spark, mart):
    raw, bronze, _, _ = mart
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    written = datamart.build_bronze(spark, raw, bronze, MONTHS)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    files = list(Path(bronze).rglob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    # One scan task of one small feed file: a shuffle would show in the number of files' task ids.
    assert len({f.name.split("-")[1] for f in files if f.stat().st_size > 100}) == 1
    assert written.count() == 51


def test_a_feed_is_written_compressed_in_files_of_few_rows(spark, tmp_path, monkeypatch):
    from catalogue import store

    monkeypatch.setitem(store.FEED_OPTIONS, "maxRecordsPerFile", 1000)
    df = spark.range(0, 5000, 1, 2).selectExpr("cast(id AS string) AS loan_id", "' a ' AS branch")
    store.write_feed(df, str(tmp_path / "feed"))
    files = list((tmp_path / "feed").glob("part-*.csv.gz"))
    assert len(files) == 6 and read_csv(spark, str(tmp_path / "feed")).count() == 5000


def test_features_join_the_order_lines_once(spark, sf_dir):
    from catalogue.fixtures import feature_clickstream

    features = feature_clickstream(spark, sf_dir)
    plan = features._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("Join") == 1
    copies = features.groupBy("Customer_ID", "snapshot_date").count()
    assert copies.where("count != if(cast(Customer_ID AS bigint) % 50 = 0, 2, 1)").count() == 0

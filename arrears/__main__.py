"""Command line: ``python -m arrears bronze|backfill|refresh|counts|vintage|train|score``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from arrears.functions.dates import month_list
from arrears.functions.delinquency import LABEL_DPD, LABEL_MOB
from arrears.layout import Layout
from arrears.operators.model import SEARCH_CANDIDATES
from arrears.plans import datamart, incremental, scoring, training
from arrears.plans.vintage import vintage_report
from arrears.session import build_session
from arrears.sources.tables import read_features

# The input feeds.
LOAN_FEED = "data/lms_loan_daily.csv"
FEATURE_FEED = "data/feature_clickstream.csv"


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="arrears", description=__doc__)
    main.add_argument("--mart", default=Layout.mart, help="data mart folder")
    main.add_argument("--bank", default=Layout.bank, help="model bank folder")
    main.add_argument("--bronze-format", default="csv", choices=["csv", "parquet"])
    main.add_argument("--features-format", default="csv", choices=["csv", "parquet"])
    jobs = main.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze", help="load one month of the loan feed")
    bronze.add_argument("--snapshotdate", required=True, help="YYYY-MM-DD")
    bronze.add_argument("--loans", default=LOAN_FEED)
    bronze.add_argument("--infer", action="store_true", help="guess the types of the feed's columns")

    backfill = jobs.add_parser("backfill", help="build bronze, silver and gold of many months")
    backfill.add_argument("--start", required=True, help="YYYY-MM-DD")
    backfill.add_argument("--end", required=True, help="YYYY-MM-DD")
    backfill.add_argument("--loans", default=LOAN_FEED)
    backfill.add_argument("--infer", action="store_true", help="guess the types of the feed's columns")
    backfill.add_argument("--dpd", type=int, default=LABEL_DPD)
    backfill.add_argument("--mob", type=int, default=LABEL_MOB)

    refresh = jobs.add_parser("refresh", help="rebuild the months whose rows in the feed changed")
    refresh.add_argument("--start", required=True, help="YYYY-MM-DD")
    refresh.add_argument("--end", required=True, help="YYYY-MM-DD")
    refresh.add_argument("--loans", default=LOAN_FEED)
    refresh.add_argument("--dpd", type=int, default=LABEL_DPD)
    refresh.add_argument("--mob", type=int, default=LABEL_MOB)

    counts = jobs.add_parser("counts", help="rows of each layer by month")
    counts.add_argument("--out", help="folder of the table; below the mart if not given")

    vintage = jobs.add_parser("vintage", help="bad rate by month on book")
    vintage.add_argument("--before", required=True, help="loans started before YYYY-MM-DD")
    vintage.add_argument("--dpd", type=int, default=LABEL_DPD)
    vintage.add_argument("--out", help="folder of the table; below the mart if not given")

    train = jobs.add_parser("train", help="search, evaluate and register a model")
    train.add_argument("--snapshotdate", required=True, help="YYYY-MM-DD")
    train.add_argument("--features", default=FEATURE_FEED)
    train.add_argument("--candidates", type=int, default=SEARCH_CANDIDATES)

    score = jobs.add_parser("score", help="score one month, or all months up to --end")
    score.add_argument("--snapshotdate", required=True, help="YYYY-MM-DD")
    score.add_argument("--end", help="YYYY-MM-DD")
    score.add_argument("--modelname", required=True)
    score.add_argument("--features", default=FEATURE_FEED)
    return main


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    layout = Layout(args.mart, args.bank)
    spark = build_session()
    bronze = args.bronze_format
    if args.job == "bronze":
        datamart.build_bronze(
            spark, args.loans, layout.bronze, [args.snapshotdate], infer=args.infer, fmt=bronze
        )
    elif args.job == "backfill":
        months = month_list(args.start, args.end)
        datamart.build_bronze(spark, args.loans, layout.bronze, months, infer=args.infer, fmt=bronze)
        datamart.build_silver(
            spark, layout.bronze, layout.silver, months, infer=args.infer, fmt=bronze
        )
        datamart.build_labels(spark, layout.silver, layout.labels, months, args.dpd, args.mob)
        report(counts_of(spark, layout, bronze), layout.report("counts"))
    elif args.job == "refresh":
        done = incremental.refresh(
            spark, args.loans, layout, month_list(args.start, args.end), dpd=args.dpd, mob=args.mob
        )
        for layer, rebuilt in done.months.items():
            print(layer, *rebuilt)
    elif args.job == "counts":
        report(counts_of(spark, layout, bronze), args.out or layout.report("counts"))
    elif args.job == "vintage":
        curve = vintage_report(spark, layout.silver, args.before, args.dpd)
        report(curve, args.out or layout.report("vintage"))
    elif args.job == "train":
        run = training.train(
            spark,
            datamart.read_labels(spark, layout.labels),
            read_features(spark, args.features, args.features_format),
            args.snapshotdate,
            layout.bank,
            n_iter=args.candidates,
        )
        run.report.show()
        training.reload_check(spark, layout.bank, run).show()
    else:
        months = month_list(args.snapshotdate, args.end) if args.end else [args.snapshotdate]
        features = read_features(spark, args.features, args.features_format)
        scoring.score(
            spark, features, layout.bank, args.modelname, layout.predictions, months
        ).show()


def counts_of(spark: SparkSession, layout: Layout, fmt: str) -> DataFrame:
    return datamart.layer_counts(
        bronze=datamart.read_bronze(spark, layout.bronze, fmt=fmt),
        silver=datamart.read_silver(spark, layout.silver, others=False),
        gold=datamart.read_labels(spark, layout.labels),
    ).orderBy("layer", "snapshot_date")


def report(df: DataFrame, path: str) -> None:
    """Write a report whole and show its beginning."""
    df.write.mode("overwrite").parquet(path)
    print(f"written to {path}; it begins:")
    df.sparkSession.read.schema(df.schema).parquet(path).orderBy(*df.columns[:2]).show()


if __name__ == "__main__":
    main()

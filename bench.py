"""Time the headline jobs and print one JSON line.

Each time is the median of three runs over the whole tables at ``BENCH_SF_DIR``;
the training jobs run once. The raw CSV feeds are written before the clock
starts; every other input is built by an earlier entry of the list.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from arrears.plans import datamart, scoring, training
from arrears.session import build_session
from catalogue import queries as q
from catalogue.fixtures import CALENDAR, MONTHS, TRAIN_DATE
from catalogue.store import Store

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
SEARCH_ITERATIONS = 10
FULL_SEARCH = 100


def run_out(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(mart: Store) -> dict:
    spark, sf = mart.spark, mart.sf_dir

    def search(n_iter, folder):
        return lambda: training.train(
            spark, datamart.read_labels(spark, mart.labels), mart.features, TRAIN_DATE, folder, n_iter=n_iter)

    def query(name):
        return lambda: run_out(q.QUERIES[name](spark, sf))

    bank = mart.folder("bench_bank")
    return {
        "silver_dpd": query("silver_dpd"),
        "gold_label": query("gold_label"),
        "csv_scan": query("csv_scan"),
        "feature_scan": query("feature_scan"),
        "bronze_backfill": lambda: datamart.build_bronze(
            spark, mart.raw, mart.folder("bench_bronze"), MONTHS),
        "silver_backfill": lambda: datamart.build_silver(
            spark, mart.bronze, mart.folder("bench_silver"), MONTHS),
        "gold_backfill": lambda: datamart.build_labels(
            spark, mart.silver, mart.folder("bench_gold"), MONTHS),
        "layer_counts": query("layer_counts"),
        "label_store_scan": query("label_store_scan"),
        "bad_rate_by_mob": query("bad_rate_by_mob"),
        "training_join": lambda: training.build_training_rows(
            spark, datamart.read_labels(spark, mart.labels), mart.features, CALENDAR, bank),
        "stratified_split": lambda: run_out(training.build_training_set(
            spark, CALENDAR, mart.folder("training"), folds=1)),
        "scaler_fit": query("scaler_fit"),
        "scaler_apply": query("scaler_apply"),
        "auc": query("auc"),
        "train": search(SEARCH_ITERATIONS, bank),
        "score_backfill": lambda: scoring.score(
            spark, mart.features, bank, q.VERSION, mart.folder("bench_predictions"), MONTHS),
        # All candidates of the job's default, with a ledger of their own; only on request, as it takes minutes.
        **({"train_full": search(FULL_SEARCH, mart.folder("bench_bank_full"))} if os.environ.get("BENCH_FULL_SEARCH") else {}),
    }


def main() -> None:
    spark = build_session(
        "arrears-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    mart = q.store(spark, SF_DIR)
    for table in (mart.raw, mart.raw_features, mart.bronze, mart.silver, mart.labels):
        assert table
    run_out(mart.training_set)

    times = {}
    for name, job in jobs(mart).items():
        taken = []
        for _ in range(1 if name in ("train", "train_full") else RUNS):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total time of the headline jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

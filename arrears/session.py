"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}

#: For sessions on a cluster: adaptive execution joins shuffle partitions that are too small, but never adds any.
CLUSTER_DEFAULTS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def build_session(app: str = "arrears", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if spark.sparkContext.master.partition("[")[0] != "local":
        for key, value in CLUSTER_DEFAULTS.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else a folder in the warehouse.

    On a cluster a warehouse on a local disk will not do.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        one_machine = context.master.partition("[")[0] == "local"
        if not one_machine and warehouse.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = warehouse.rstrip("/") + "/arrears-work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{root}/checkpoints")
    return root


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="arrears-package-")) / "arrears-package.zip"
    with zipfile.ZipFile(target, "w") as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)

"""Intermediate tables in the shared folder, and the package on the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.session import work_dir

_shipped: set[str] = set()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="arrears-code-")) / "arrears-code.zip"
    with zipfile.ZipFile(target, "w") as code:
        for file in sorted(root.rglob("*.py")):
            code.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a row by its id and text; equal rows share them. Nulls differ from every value."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(part(doc_id), F.lit("\x00"), part(text)).cast("binary")))


def text_column(docs: DataFrame, name: str) -> Column:
    """A text column with null read as empty; any name, dots included."""
    return F.coalesce(column(docs, name).cast("string"), F.lit(""))


def column(df: DataFrame, name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

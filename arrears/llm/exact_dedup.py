"""Exact duplicates by content sort.

Sampled splitters range-partition the normalised texts, an external sort puts
equal ones side by side, and neighbours are compared in full: a run of equal
texts keeps the row with the most code points in its original text, then the
smallest id. DataFrame functions only.

A text that many rows share would fill one range. Such texts are found first by
their SHA-256 (aggregated before the shuffle) and sorted in slices; there are
fewer than ``HOT_SHARES`` of them, so their winners are a bounded broadcast.

Null texts count as empty. Rows equal in text and id are told apart by their
place in the sort only: one of them stays. A null id sorts last. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.tables import column, text_column

#: A text is hot when more rows have it than ``HOT_ROWS`` and than two in ``HOT_SHARES`` of all;
#: it is sorted in slices of about the larger of ``HOT_ROWS`` and one in ``HOT_SHARES`` of all rows.
HOT_SHARES = 4096
HOT_ROWS = 64

#: Characters of a text that splitters are made of.
HEAD = 32

#: Fixed value: the characters that normalising deletes.
SPACES = " \t\n\x0b\x0c\r"


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    With ``carry`` the columns of ``docs`` come along, as a struct ``row``.
    """
    text = text_column(docs, text_col)
    rows = docs.select(
        column(docs, id_col).alias("doc_id"),
        F.translate(text, SPACES, "").alias("norm"),
        F.char_length(text).alias("points"),
        *([F.struct(*(column(docs, c) for c in docs.columns)).alias("row")] if carry else []),
    )
    rank = F.struct((-F.col("points")).alias("neg_points"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
    slice_rows = max(HOT_ROWS, docs.count() / HOT_SHARES)
    hot = (
        rows.select(F.sha2("norm", 256).alias("hot_sha"), rank.alias("rank"))
        .groupBy("hot_sha")
        .agg(F.count(F.lit(1)).alias("hot_size"), F.min("rank").alias("hot_rank"))
        .where(F.col("hot_size") > 2 * slice_rows)
    )
    n_slices = F.coalesce(F.ceil(F.col("hot_size") / slice_rows), F.lit(1))
    sliced = (
        rows.withColumn("text_sha256", F.sha2("norm", 256))
        .join(F.broadcast(hot), F.col("text_sha256") == F.col("hot_sha"), "left")
        .withColumn("slice", F.pmod(F.xxhash64("doc_id", "points"), n_slices))
        .drop("hot_sha")
    )
    # Splitters are sampled from beginnings, as whole texts would swell the sample; the hash parts texts that begin
    # alike. Equal texts agree in all of it, and the sort and the comparison take the whole text.
    sliced = sliced.withColumn("head", F.substring("norm", 1, HEAD))
    run = Window.partitionBy("head", "text_sha256", "norm", "slice")
    first = run.orderBy(F.desc("points"), F.asc_nulls_last("doc_id"))
    placed = sliced.repartitionByRange("head", "text_sha256", "slice").select(
        "*",
        F.row_number().over(first).alias("place"),
        F.first("doc_id").over(first).alias("first_id"),
        F.count(F.lit(1)).over(run).alias("run_size"),
    )
    is_hot = F.col("hot_size").isNotNull()
    keep_id = F.when(is_hot, F.col("hot_rank.doc_id")).otherwise(F.col("first_id"))
    # The winner of a hot text is the best row of its slice; equal rows always share a slice.
    kept = (F.col("place") == 1) & (~is_hot | (F.col("hot_rank") == rank))
    return placed.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("hot_size", "run_size").cast("long").alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs`` as they are."""
    found = exact_duplicates(docs, id_col, text_col, carry=True)
    return found.where("kept").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))

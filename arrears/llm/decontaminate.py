"""Benchmark passages in documents, by winnowing.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
passage is ``window`` consecutive words of an item; an item with fewer words is
one passage. Of every ``window - k + 1`` neighbouring k-grams the one with the
lowest hash is kept as a fingerprint, on both sides, so any shared run of
``window`` words shares a fingerprint at the same place. Fingerprints of
documents are joined with those of the items and each match is extended word by
word; runs of ``window`` words or more are hits. Short items are fingerprinted
whole, by their own length.

Before the join, a bit array of fixed size holds the items' fingerprints, and
document fingerprints that are not in it are dropped in the scan: with a large
benchmark it lets more through, but the result is the same. Equal contexts in
many items are joined once.

Null texts have no words. Rows equal in id and text are separate rows of the
result. An item id that occurs twice is one item; a null item id is left out of
``items``. No items or no documents give zero hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.tables import column, fresh, row_key, ship, written
from arrears.llm.words import Words, find_words, grams, slices

WINDOW = 13
K = 7
FILTER_BITS = 24

_CONTEXT = "pos:long,gram:array<string>,before:array<string>,after:array<string>"
_FOUND = f"fp:long,{_CONTEXT}"


def _winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Which hashes are the lowest of some ``width`` neighbours."""
    keep = np.zeros(len(hashes), bool)
    n = len(hashes) - width + 1
    if n <= 0:
        return keep
    low = hashes[:n].copy()
    for j in range(1, width):
        np.minimum(low, hashes[j : j + n], out=low)
    for j in range(width):
        keep[j : j + n] |= hashes[j : j + n] == low
    return keep


def _inside(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of n positions begin k words of one text."""
    ends = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + k <= ends


def _fingerprints(words: Words, window: int, k: int, short: list[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(length, reach of the context, positions, fingerprints): the winnowed k-grams, then all of each short length, k too."""
    for size, winnowed in [(k, True), *((n, False) for n in short)]:
        hashes = grams(words.hash, size)
        fits = _inside(words.first, len(hashes), size)
        if winnowed:
            # A k-gram across two texts must not hide one of either text.
            fits &= _winnow(np.where(fits, hashes, np.uint64(2**64 - 1)), window - k + 1)
        at = np.flatnonzero(fits)
        yield size, window - k if winnowed else 0, at, hashes[at]


def _context(words: Words, text: int, at: int, size: int, reach: int) -> tuple[list[str], list[str], list[str]]:
    """The gram, up to ``reach`` words before it, nearest first, and after it."""
    begin, end = max(words.first[text], at - reach), min(words.first[text + 1], at + size + reach)
    near = words.text(begin, end)
    cut = at - begin
    return near[cut : cut + size], near[:cut][::-1], near[cut + size :]


def _rows(words: Words, window: int, k: int, short: list[int], wanted) -> list[list[dict]]:
    rows: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    for size, reach, at, prints in _fingerprints(words, window, k, short):
        keep = wanted(prints)
        at, prints = at[keep], prints[keep]
        texts = np.searchsorted(words.first, at, "right") - 1
        for i, p, h in zip(texts.tolist(), at.tolist(), prints.view(np.int64).tolist(), strict=True):
            gram, before, after = _context(words, i, p, size, reach)
            rows[i].append({"fp": h, "pos": p - int(words.first[i]), "gram": gram, "before": before, "after": after})
    return rows


_STRUCT = pa.list_(pa.struct([
    ("fp", pa.int64()), ("pos", pa.int64()),
    *((c, pa.list_(pa.string())) for c in ("gram", "before", "after")),
]))


def _item_prints(items: DataFrame, window: int, k: int) -> DataFrame:
    """(item_id, need, fp, pos, gram, before, after) of all items; need is the length of a hit."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                words = find_words(part.column(1))
                counts = np.diff(words.first)
                rows = _rows(words, window, k, [], lambda h: np.ones(len(h), bool))
                for i in np.flatnonzero((counts > 0) & (counts < window)):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    whole = grams(words.hash[a:b], b - a).view(np.int64)
                    rows[i] = [{"fp": int(whole[0]), "pos": 0, "gram": words.text(a, b), "before": [], "after": []}]
                need = pa.array(np.minimum(counts, window), pa.int64())
                yield pa.record_batch([part.column(0), need, pa.array(rows, _STRUCT)], names=["item_id", "need", "fps"])

    return items.mapInArrow(prints, f"item_id string, need long, fps array<struct<{_FOUND}>>").select(
        "item_id", "need", F.inline("fps")
    )


def _bits(prints: DataFrame, bits: int) -> np.ndarray:
    """Bit array of ``2 ** bits`` bits, set where some fingerprint falls: a result of bounded size."""
    word = F.shiftrightunsigned("fp", 64 - bits)
    cells = prints.select(word.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(bit, 64) AS INT))")).alias("set")
    ).toPandas()
    array = np.zeros(1 << (bits - 6), np.int64)
    array[cells["cell"].to_numpy(np.int64)] = cells["set"].to_numpy(np.int64)
    return array.view(np.uint64)


def _scan(docs: DataFrame, window: int, k: int, short: list[int], bits: int, filled: np.ndarray) -> DataFrame:
    """One row per document: row, doc_id, key, n_words, and its fingerprints that pass the bit array."""
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def wanted(prints: np.ndarray) -> np.ndarray:
        bit = prints >> np.uint64(64 - bits)
        return (shared.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 2):
                words = find_words(part.column(2))
                found = _rows(words, window, k, short, wanted)
                rows = pa.array(np.arange(row, row + len(part)), pa.int64())
                row += len(part)
                yield pa.record_batch(
                    [rows, part.column(0), part.column(1), pa.array(np.diff(words.first), pa.int64()),
                     pa.array(found, _STRUCT)],
                    names=["row", "doc_id", "key", "n_words", "fps"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, key binary, n_words long, fps array<struct<{_FOUND}>>"
    return docs.mapInArrow(scan, schema)


def _shared(a: str, b: str) -> Column:
    """How many leading elements two arrays of words have in common."""
    return F.expr(
        f"aggregate(sequence(1, greatest(1, least(size({a}), size({b})))), 0, (n, i) ->"
        f" IF(n = i - 1 AND get({a}, i - 1) = get({b}, i - 1), i, n))"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    k: int = K,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document: doc_id, key (``row_key``), n_words, n_hit, items (sorted ids as text), spans of hit words."""
    spark = docs.sparkSession
    ship(spark)
    item_rows = items.select(column(items, item_id_col).cast("string").alias("id"), column(items, item_text_col).cast("string").alias("text"))
    prints = written(_item_prints(item_rows, window, k), "item-prints")
    context = ["fp", "gram", "before", "after", "need"]
    contexts = prints.groupBy(F.sha2(F.to_json(F.struct(*context)), 256).alias("context")).agg(
        *(F.first(c).alias(f"i_{c}") for c in context)
    )
    # At most window - 1 lengths.
    short = sorted(r.need for r in prints.where(F.col("need") < window).select("need").distinct().collect())
    doc_id, text = column(docs, id_col), column(docs, text_col).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), row_key(doc_id, text).alias("key"), text.alias("text"))
    base = written(_scan(rows, window, k, short, filter_bits, _bits(prints, filter_bits)), "document-prints")

    runs = (
        base.select("row", F.inline("fps"))
        .join(contexts, (F.col("fp") == F.col("i_fp")) & (F.col("gram") == F.col("i_gram")))
        .withColumn("left_n", _shared("before", "i_before"))
        .withColumn("right_n", _shared("after", "i_after"))
        .where(F.col("left_n") + F.size("gram") + F.col("right_n") >= F.col("i_need"))
        .select(
            "row", "context",
            (F.col("pos") - F.col("left_n")).alias("begin"),
            (F.col("pos") + F.size("gram") + F.col("right_n")).alias("end"),
        )
    )
    runs = written(runs, "hit-runs")
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    hits = (
        runs.select("row", "begin", "end").distinct()
        .select("row", "end", F.greatest("begin", reached).alias("begin"))
        .where("end > begin")
        .groupBy("row")
        .agg(
            F.sum(F.col("end") - F.col("begin")).alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"),
        )
    )
    members = prints.select(
        F.sha2(F.to_json(F.struct(*context)), 256).alias("context"), "item_id"
    ).distinct()
    named = (
        runs.select("row", "context").distinct().join(members, "context")
        .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    return (
        base.select("row", "doc_id", "key", "n_words")
        .join(hits, "row", "left")
        .join(named, "row", "left")
        .select(
            "doc_id", "key", "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<begin:long,end:long>>")).alias("spans"),
        )
    )


def is_contaminated() -> Column:
    """At least one hit, and hits make up a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, columns as they are. Equal rows share their fate."""
    name = fresh(docs, "bad_key")
    bad = contamination(docs, items, id_col, text_col).where(is_contaminated()).select(F.col("key").alias(name)).distinct()
    key = row_key(column(docs, id_col), column(docs, text_col))
    return docs.join(bad, key == F.col(name), "left_anti")

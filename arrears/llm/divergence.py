"""Source divergence audit: how far the term shares of a language's sources lie apart, by an Arrow compute pipeline.

1. Inside ``mapInArrow``, slices of a few megabytes of whole texts are
   lower-cased (``ascii_lower``), split (``split_pattern_regex``),
   dictionary-encoded and counted by two hash ``group_by``: per text and term,
   then per group and term. A task merges its counts and hands them on whenever
   they outgrow ``MOST_COUNTS`` rows, so its memory is bounded. A hot source
   reaches the shuffle as one row a task and term.
2. Spark adds the partial counts up by language, source and term, then gathers a
   term's sources into one row: a columnar shard is any run of such rows. Terms
   in fewer than ``min_docs`` documents of the language go.
3. Each task turns its shard into matrices of terms by sources and adds up the
   divergences of all ordered pairs of sources; of the terms that a source
   prefers it keeps the ``top`` best, which is exact, as a term lies in one shard.
   Spark adds the sums and ranks.

Shares are whole numbers in billionths, and all arithmetic is exact as long as a
group has fewer than 9 * 10^15 terms. A task keeps one number for each ordered
pair of sources of a language, and the driver one row a (language, source): the
report has a row for each of those pairs, so both are small beside it.

Null language, source and text count as empty text. A text without terms gives
its group and no counts. Repeated rows count each by itself, and so do their
documents. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.tables import ship, text_column, written
from arrears.llm.words import slices

# What separates terms, the documents a term needs, the unit of shares and the length of the term report.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
UNIT = 10**9
TOP = 200

#: Rows of partial counts that a task gathers before it hands them on.
MOST_COUNTS = 1 << 18

#: Cells of a matrix of terms by sources.
_CELLS = 1 << 18

_KEYS = ["lang", "source", "term"]


def count_terms(some: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term) in a batch of lang, source and text."""
    words = pc.split_pattern_regex(pc.ascii_lower(some.column("text")), pattern=SEPARATORS)
    term, owner = pc.list_flatten(words), pc.list_parent_indices(words)
    full = pc.not_equal(term, "")
    term, owner = term.filter(full).dictionary_encode(), owner.filter(full)
    in_text = pa.table({"owner": owner, "term": term.indices}).group_by(["owner", "term"], use_threads=False).aggregate([([], "count_all")])
    lang, source = (some.column(c).dictionary_encode() for c in ("lang", "source"))
    at = in_text["owner"].combine_chunks()
    in_group = pa.table({
        "lang": lang.indices.take(at), "source": source.indices.take(at), "term": in_text["term"], "n": in_text["count_all"],
    }).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    words_of = {"lang": lang.dictionary, "source": source.dictionary, "term": term.dictionary}
    return pa.table(
        {k: words_of[k].take(in_group[k].combine_chunks()) for k in _KEYS}
        | {"n": in_group["n_sum"], "docs": in_group["n_count"]}
    )


def _merge(parts: list[pa.Table]) -> pa.Table:
    """The parts' counts added up."""
    together = pa.concat_tables(parts).combine_chunks()
    if len(parts) == 1:
        return together
    # Strings are grouped by their numbers: the dictionaries are built once.
    coded = {k: pc.dictionary_encode(together[k].combine_chunks()) for k in _KEYS}
    summed = pa.table({k: c.indices for k, c in coded.items()} | {c: together[c] for c in ("n", "docs")}).group_by(
        _KEYS, use_threads=False
    ).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table(
        {k: coded[k].dictionary.take(summed[k].combine_chunks()) for k in _KEYS}
        | {"n": summed["n_sum"], "docs": summed["docs_sum"]}
    )


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts; a key comes once for each time that the counts were handed on."""
    parts: list[pa.Table] = []
    rows = least = 0
    for batch in batches:
        for some in slices(batch, batch.schema.get_field_index("text")):
            parts.append(count_terms(some))
            rows += len(parts[-1])
            if rows > least + MOST_COUNTS:
                parts = [_merge(parts)]
                rows = least = len(parts[0])
                if rows > MOST_COUNTS:
                    yield from parts[0].to_batches(max_chunksize=1 << 16)
                    parts, rows, least = [], 0, 0
    if parts:
        yield from _merge(parts).to_batches(max_chunksize=1 << 16)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total) for count < total, three digits at a time so that nothing overflows."""
    quotient, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + digit
    return quotient + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Best:
    """The ``top`` terms of one group with the greatest values; ties go to the lesser bytes."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def add(self, value: np.ndarray, order: np.ndarray, terms: pa.Array) -> None:
        """Terms ``order`` numbers by their bytes."""
        if len(self.rows) == self.top:
            able = np.flatnonzero(value >= -self.rows[-1][0])
        else:
            able = np.arange(len(value))
        able = able[np.lexsort((order[able], -value[able]))[: self.top]]
        new = [(-v, t.encode()) for v, t in zip(value[able].tolist(), terms.take(pa.array(able)).to_pylist(), strict=True)]
        self.rows = sorted(self.rows + new)[: self.top]


def _shard_report(groups: dict[str, tuple[list[str], np.ndarray, int, int]], top: int):
    """The function for ``mapInArrow`` that turns rows of terms into partial sums and candidate terms.

    ``groups`` has for each language its sources, their totals N + V, and the language's N + V and V.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        best: dict[tuple[str, int], _Best] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = batch.filter(pc.equal(langs.indices, code))
                names, totals, total, _ = groups[lang]
                height = max(1, _CELLS // len(names))
                for a in range(0, len(rows), height):
                    _add_block(rows.slice(a, height), lang, names, totals, total, sums, best, top)
        for lang, matrix in sums.items():
            names = groups[lang][0]
            for i, name in enumerate(names):
                others = [j for j in range(len(names)) if j != i]
                yield _rows(lang, name, "pair", [names[j] for j in others], matrix[i, others])
        for (lang, i), kept in best.items():
            yield _rows(lang, groups[lang][0][i], "term", [t.decode() for _, t in kept.rows], [-v for v, _ in kept.rows])

    return report


def _add_block(rows, lang, names, totals, total, sums, best, top) -> None:
    lists = rows.column("sources")
    count = np.zeros((len(rows), len(names)), np.int64)
    at = pc.index_in(lists.flatten(), value_set=pa.array(names, pa.string())).to_numpy()
    count[pc.list_parent_indices(lists).to_numpy(), at] = rows.column("counts").flatten().to_numpy()
    p = share(count, totals[None, :])
    if lang not in sums:
        sums[lang] = np.zeros((len(names), len(names)), np.int64)
    for i in range(len(names)):
        sums[lang][i] += distance(p[:, i : i + 1], p).sum(axis=0)
    q = share(rows.column("n").to_numpy(), np.int64(total))
    terms = rows.column("term")
    order = np.empty(len(rows), np.int64)
    order[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(rows))
    for i in range(len(names)):
        mine = np.flatnonzero((count[:, i] > 0) & (p[:, i] > q))
        if len(mine):
            kept = best.setdefault((lang, i), _Best(top))
            kept.add(distance(p[mine, i], q[mine]), order[mine], terms.take(pa.array(mine)))


def _rows(lang: str, source: str, part: str, items: list[str], values) -> pa.RecordBatch:
    n = len(items)
    columns = [pa.array([x] * n, pa.string()) for x in (lang, source, part)]
    return pa.record_batch(
        [*columns, pa.array(items, pa.string()), pa.array(values, pa.int64())], names=["lang", "source", "part", "item", "value"]
    )


def term_rows(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, n and the sources and counts behind it, for the terms in ``min_docs`` documents of their language."""
    counts = docs.mapInArrow(partial_counts, "lang string, source string, term string, n long, docs long")
    per_source = counts.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    gathered = per_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("of")
    )
    return gathered.where(F.col("docs") >= min_docs).select(
        "lang", "term", "n", F.col("of.source").alias("sources"), F.col("of.n").alias("counts")
    )


def divergence_report(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
) -> DataFrame:
    """lang, source, part, item, value and rank: all other sources (``pair``) and preferred terms (``term``) of each group."""
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(
        text_column(docs, lang_col).alias("lang"), text_column(docs, source_col).alias("source"), text_column(docs, text_col).alias("text")
    )
    terms = written(term_rows(named, min_docs), "divergence-terms")
    sizes = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("of")).groupBy(
        "lang", F.col("of.sources").alias("source")
    ).agg(F.sum("of.counts").alias("n"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    groups = written(
        named.select("lang", "source").distinct()
        .join(sizes, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["n", "v", "lang_n"]),
        "divergence-groups",
    )
    # One row per (language, source); the report has more rows than its square within each language.
    known: dict[str, list] = {}
    for row in groups.orderBy("lang", "source").collect():
        known.setdefault(row.lang, []).append(row)
    shared = {
        lang: ([r.source for r in rows], np.array([r.n + r.v for r in rows], np.int64), rows[0].lang_n + rows[0].v, rows[0].v)
        for lang, rows in known.items()
    }
    report = _shard_report(shared, top)
    found = written(terms.mapInArrow(report, "lang string, source string, part string, item string, value long"), "divergence-parts")
    other = groups.select("lang", F.col("source").alias("item"))
    nothing = groups.join(other, "lang").where(F.col("source") != F.col("item")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")
    )
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = found.where(F.col("part") == "pair").unionByName(nothing).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    preferred = found.where(F.col("part") == "term")
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    return ranked.unionByName(preferred.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))

"""Stratified split of exact size without a global sort.

Rows of each class are put in the order of a salted hash and cut at given
ranks. Ranking all rows of a class would be one task per class. Instead, rows
are counted by class and hash prefix, the counts show which prefix holds each
cut, and only the loans of those prefixes are counted and ranked; a loan with
many rows is narrowed down once more in the same way. The cuts are a few rows:
placing a row compares it with the cuts of its class and needs no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from arrears.schemas import ddl, quoted

# Train share, seed of the split.
TRAIN_RATIO = 0.8
SPLIT_SEED = 88

# Hex digits of the prefix: 16^4 counts per class, however many rows there are.
_PREFIX = 4

# Rows of one loan are counted by the upper 16 bits of their 64-bit hash.
_ROW_SHIFT = 48
_LAST_ROW = 2**63 - 1


def class_sizes(counts: DataFrame, label: str = "label", ratio: float = TRAIN_RATIO) -> DataFrame:
    """Train rows per class, from one row per class with its count ``n``.

    The test part is rounded up over all classes; the train part is shared out
    in proportion, with the left-over rows to the largest fractions.
    """
    everyone = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everyone)
    by_fraction = everyone.orderBy(F.desc("fraction"), label)
    return (
        counts.withColumn("total", total)
        .withColumn("n_train_all", F.col("total") - F.ceil(F.lit(1 - ratio) * F.col("total")))
        .withColumn("share", F.col("n") / F.col("total") * F.col("n_train_all"))
        .withColumn("fraction", F.col("share") - F.floor("share"))
        .withColumn("left_over", F.col("n_train_all") - F.sum(F.floor("share")).over(everyone))
        .withColumn("extra", F.row_number().over(by_fraction) <= F.col("left_over"))
        .select(label, "n", (F.floor("share") + F.col("extra").cast("bigint")).alias("n_train"))
    )


@dataclass(frozen=True)
class StratifiedCuts:
    """Cuts of each class: the last rank keys of ``folds`` equal parts of its train rows.

    The order is the md5 of key and seed, then the key, then a hash of the
    whole row, then a hash of its ``row_id``: columns that differ for equal rows,
    such as file and row number of a written table. So a loan with many rows and
    a group of equal rows are cut exactly. Without a ``row_id`` equal rows stay
    together.
    """

    cuts: dict[object, list[tuple[str, str, int, int]]]
    folds: int
    key: str
    label: str
    seed: int
    row_id: tuple[str, ...] = ()

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        key: str = "loan_id",
        label: str = "label",
        ratio: float = TRAIN_RATIO,
        seed: int = SPLIT_SEED,
        folds: int = 1,
        row_id: tuple[str, ...] = (),
    ) -> StratifiedCuts:
        levels = _levels(df, key, seed, row_id)
        edges = _first_edges(df, levels["prefix"], label, ratio, folds)
        edges = _refine(df, levels, label, edges, ["prefix"], "loan")
        # A cut behind the last row of a loan needs no order inside the loan.
        inside = [edge for edge in edges if edge.rank < edge.n]
        if inside:
            inside = _refine(df, levels, label, inside, ["loan"], "bucket")
            inside = _refine(df, levels, label, inside, ["loan", "bucket"], "row")
        copies = [edge for edge in inside if edge.rank < edge.n] if row_id else []
        if copies:
            copies = _refine(df, levels, label, copies, ["loan", "row"], "copy_bucket")
            copies = _refine(df, levels, label, copies, ["loan", "row", "copy_bucket"], "copy")

        cuts = {(edge[label], edge.cut): (*edge.loan, _LAST_ROW, _LAST_ROW) for edge in edges}
        cuts |= {(edge[label], edge.cut): (*edge.loan, edge.row, _LAST_ROW) for edge in inside}
        cuts |= {(edge[label], edge.cut): (*edge.loan, edge.row, edge.copy) for edge in copies}
        by_class = defaultdict(list)
        for (value, _), rank_key in sorted(cuts.items(), key=lambda item: item[0][1]):
            by_class[value].append(rank_key)
        return cls(dict(by_class), folds, key, label, seed, row_id)

    def place(self, df: DataFrame, part: str) -> DataFrame:
        """Add the number of cuts before a row: the parts of train in order, then test.

        A part without rows has no cut and every row of the class is past it.
        """
        passed = F.lit(self.folds)
        for value, keys in self.cuts.items():
            cuts = sum((self._after(df, key).cast("int") for key in keys), F.lit(0))
            passed = F.when(
                F.col(self.label) == value, cuts + F.lit(self.folds - len(keys))
            ).otherwise(passed)
        hashed = df.withColumn("_hash", _md5(self.key, self.seed))
        return hashed.select(*map(quoted, df.columns), passed.alias(part))

    def _after(self, df: DataFrame, rank_key: tuple[str, str, int, int]) -> Column:
        """Whether a row comes after a rank key; most rows differ in the hash already."""
        cut_hash, cut_key, cut_row, cut_copy = rank_key
        key, row, copy = _text(self.key), _row_hash(df, self.row_id), _copy_hash(self.row_id)
        last_row, last_copy = F.lit(cut_row).cast("bigint"), F.lit(cut_copy).cast("bigint")
        in_loan = (key == cut_key) & ((row > last_row) | ((row == last_row) & (copy > last_copy)))
        return (F.col("_hash") > cut_hash) | (
            (F.col("_hash") == cut_hash) & ((key > cut_key) | in_loan)
        )


def stratified_split(df: DataFrame, folds: int = 1, **options) -> DataFrame:
    """Add ``split`` and ``fold`` to rows with a ``segment``.

    Rows of the ``train_test`` segment become ``train`` or ``test``; train rows
    are numbered 0 to ``folds`` - 1 in stratified parts of equal size. The
    out-of-time rows keep ``oot``. ``row_id`` columns are left out of the result.
    """
    inside = F.col("segment") == "train_test"
    cuts = StratifiedCuts.fit(df.where(inside), folds=folds, **options)
    train = inside & (F.col("_part") < folds)
    split = F.when(F.col("segment") == "oot", "oot").when(train, "train").when(inside, "test")
    kept = [quoted(name) for name in df.columns if name not in cuts.row_id]
    return cuts.place(df, "_part").select(
        *kept, split.alias("split"), F.when(train, F.col("_part")).alias("fold")
    )


def _first_edges(
    df: DataFrame, prefix: Column, label: str, ratio: float, folds: int
) -> list[Row]:
    """Prefix that holds each cut, with the cut's rank inside: a row per class and fold."""
    # At most 16^4 rows per class, read twice below.
    counts = df.groupBy(label, prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).persist()
    sizes = class_sizes(counts.groupBy(label).agg(F.sum("n").alias("n")), label, ratio)
    ends = [F.floor(F.col("n_train") * i / folds) for i in range(1, folds)] + [F.col("n_train")]
    wanted = sizes.select(label, F.posexplode(F.array(*ends)).alias("cut", "rank"))
    running = Window.partitionBy(label).orderBy("prefix")
    spans = counts.withColumn("end", F.sum("n").over(running))
    try:
        return _holding(spans.join(F.broadcast(wanted), label), [label, "prefix"]).collect()
    finally:
        counts.unpersist()


def _refine(
    df: DataFrame,
    levels: dict[str, Column],
    label: str,
    edges: list[Row],
    given: list[str],
    level: str,
) -> list[Row]:
    """Look inside the groups that hold a cut: the next level's group and rank."""
    keys = [label, *given]
    near = df
    for name in given:
        near = near.where(levels[name].isin([_literal(value) for value in {e[name] for e in edges}]))
    groups = (
        near
        .select(label, *[levels[name].alias(name) for name in [*given, level]])
        .groupBy(*keys, level).agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy(*keys).orderBy(level)
    spans = groups.withColumn("end", F.sum("n").over(running))
    kinds = dict(groups.dtypes) | {"cut": "int", "rank": "bigint"}
    names = [*keys, "cut", "rank"]
    wanted = df.sparkSession.createDataFrame(
        [tuple(edge[name] for name in names) for edge in edges],
        ddl({name: kinds[name] for name in names}),
    )
    return _holding(spans.join(F.broadcast(wanted), keys), [*keys, level]).collect()


def _holding(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose ranks, up to ``end``, include the wanted ``rank``."""
    start = F.col("end") - F.col("n")
    return spans.where((start < F.col("rank")) & (F.col("rank") <= F.col("end"))).select(
        *keys, "cut", (F.col("rank") - start).alias("rank"), "n"
    )


def _levels(df: DataFrame, key: str, seed: int, row_id: tuple[str, ...]) -> dict[str, Column]:
    """Parts of the rank key, coarse to fine; few groups lie inside each one."""
    md5, row, copy = _md5(key, seed), _row_hash(df, row_id), _copy_hash(row_id)
    return {
        "prefix": F.substring(md5, 1, _PREFIX),
        "loan": F.struct(md5.alias("hash"), _text(key).alias("key")),
        "bucket": F.shiftright(row, _ROW_SHIFT),
        "row": row,
        "copy_bucket": F.shiftright(copy, _ROW_SHIFT),
        "copy": copy,
    }


def _literal(value) -> Column:
    if isinstance(value, Row):
        return F.struct(*[F.lit(part).alias(name) for name, part in value.asDict().items()])
    return F.lit(value)


def _md5(key: str, seed: int) -> Column:
    return F.md5(F.concat(_text(key), F.lit(f"|{seed}")))


def _text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def _row_hash(df: DataFrame, row_id: tuple[str, ...]) -> Column:
    return F.xxhash64(*[quoted(name) for name in df.columns if name not in row_id])


def _copy_hash(row_id: tuple[str, ...]) -> Column:
    return F.xxhash64(*map(quoted, row_id)) if row_id else F.lit(0).cast("bigint")

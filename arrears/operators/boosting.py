"""Second-order gradient boosting of many models at once, on histograms that Spark adds up.

All models of a search share one scan and one set of bins. The rows lie packed in
blocks: bins of every feature, label, fold and a hash that names the row. A level
of all trees of all models is one job: each task sums gradients and second
derivatives by model, node, feature and bin, the sums of a model meet in a tree of
tasks, and the best split of each of its nodes is all that the driver sees.

Sums are of whole numbers (derivatives in units of 2^-28), so neither the order of
the additions nor the layout of the rows changes a model; rows and columns of a
tree are drawn by hashes of the row, the tree and the seed.

For a node with sums G and H the weight is ``-soft(G) / (H + reg_lambda)``, where
``soft`` moves G towards 0 by ``reg_alpha``; a split gains ``soft(G)^2 / (H +
reg_lambda)`` of both children less that of the node. Both children need
``min_child_weight`` in H, and a split above two leaves must gain ``gamma`` to stay.
The rate ``learning_rate`` applies to every tree, and the first one starts at the
log-odds of the labels. Missing values go to the side where the split gains more,
to the right where it makes no difference.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.operators.quantiles import summaries

#: Whole numbers that one unit of gradient is cut into: sums are exact for 2^35 rows.
UNIT = 1 << 28

#: Ranges of each feature that a split may fall between.
BINS = 256

#: Rows of a block, blocks of an Arrow batch, and trees between two times that margins are written.
BLOCK = 1 << 14
BATCH_BLOCKS = 4
TREES_A_STATE = 16

#: Rows that a task has at least, if there are tasks for all cores: each task sends histograms of its own.
ROWS_A_TASK = 1 << 19

#: Nodes of a tree that is walked split by split, with one byte a row.
SMALL_TREE = 255

#: Bytes of histograms that a task holds, and histograms of a model that one task adds up.
HISTOGRAM_BYTES = 256 << 20
FAN_IN = 64

#: Least gain of a split.
_LEAST_GAIN = 1e-6

_BLOCKS = "n int, bins binary, label binary, fold binary, draw binary, margins binary"


@dataclass(frozen=True)
class Settings:
    """What one model is fitted with; ``fold`` is left out of its rows, -1 leaves out none."""

    n_estimators: int = 50
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    fold: int = -1


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i + 1 (up to ``bin``) and 2i + 2; ``feature`` is -1 in a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def leaf(cls, depth: int, value: float) -> Tree:
        size = (2 << depth) - 1
        tree = cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, bool), np.zeros(size), np.zeros(size))
        tree.value[0] = value
        return tree

    def nodes(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The node each row ends in; ``bins`` has a row per feature."""
        if len(self.feature) <= SMALL_TREE:
            return self._small_nodes(bins, missing)
        node = np.zeros(bins.shape[1], np.int32)
        rows = np.arange(bins.shape[1])
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            feature = self.feature[node]
            if (feature < 0).all():
                break
            own = bins[feature, rows]
            left = np.where(own == missing, self.missing_left[node], own <= self.bin[node])
            node = np.where(feature >= 0, 2 * node + 2 - left, node)
        return node

    def _small_nodes(self, bins: np.ndarray, missing: int) -> np.ndarray:
        node = np.zeros(bins.shape[1], np.uint8)
        for i in np.flatnonzero(self.feature >= 0).tolist():
            own = bins[self.feature[i]]
            left = own <= int(self.bin[i])
            if self.missing_left[i]:
                left |= own == missing
            step = np.uint8(i + 2) - left.view(np.uint8)
            step *= node == i
            node += step
        return node.astype(np.intp)

    def prune(self, gamma: float) -> None:
        """Take back splits above two leaves that gain less than ``gamma``, from the bottom up."""
        for node in range(len(self.feature) // 2 - 1, -1, -1):
            children = (2 * node + 1, 2 * node + 2)
            if self.feature[node] >= 0 and self.gain[node] < gamma and all(self.feature[c] < 0 for c in children):
                self.feature[node] = -1


@dataclass
class Model:
    """A fitted model; bins become values by ``cuts``."""

    settings: Settings
    start: float
    cuts: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    def margin(self, inputs: Sequence[str]) -> str:
        """SQL of the log-odds; ``inputs`` are SQL of the features, NULL where missing."""
        rate = self.settings.learning_rate
        return " + ".join([f"{self.start!r}D", *(f"({self._branch(t, 0, inputs, rate)})" for t in self.trees)])

    def _branch(self, tree: Tree, node: int, inputs: Sequence[str], rate: float) -> str:
        feature = tree.feature[node]
        if feature < 0:
            return f"{float(rate * tree.value[node])!r}D"
        value, cut = inputs[feature], float(self.cuts[feature][tree.bin[node]])
        left, right = (self._branch(tree, 2 * node + 1 + side, inputs, rate) for side in (0, 1))
        missing = left if tree.missing_left[node] else right
        return f"CASE WHEN {value} IS NULL THEN {missing} WHEN {value} <= {cut!r}D THEN {left} ELSE {right} END"

    def importances(self) -> np.ndarray:
        """Mean gain of each feature's splits, as shares of 1; 0 for all in a model without splits."""
        features = np.concatenate([t.feature[t.feature >= 0] for t in self.trees] or [np.zeros(0, int)])
        gains = np.concatenate([t.gain[t.feature >= 0] for t in self.trees] or [np.zeros(0)])
        n = len(self.cuts)
        mean = np.bincount(features, gains, n) / np.maximum(1, np.bincount(features, minlength=n))
        return mean / mean.sum() if mean.sum() else mean


@dataclass(frozen=True)
class Blocks:
    """Packed rows of a training matrix, as a table in a session of their own, and what all models share."""

    table: DataFrame
    cuts: list[np.ndarray]
    parts: int
    positives: dict[int, int]
    rows: dict[int, int]
    path: str

    @property
    def missing(self) -> int:
        """The bin of missing values."""
        return max((len(c) for c in self.cuts), default=0) + 1

    def start(self, fold: int) -> float:
        """Log-odds of the labels outside a fold."""
        n = sum(count for f, count in self.rows.items() if f != fold)
        positives = sum(count for f, count in self.positives.items() if f != fold)
        share = min(max(positives / n, 1e-6), 1 - 1e-6) if n else 0.5
        return math.log(share / (1 - share))


def _uniform(hashes: np.ndarray, *numbers: int) -> np.ndarray:
    """Numbers from 0 to 1 that follow from hashes and a few whole numbers (rounds of the splitmix64 finaliser)."""
    x = hashes
    for number in numbers:
        x = x + np.uint64((number * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)) * 2.0**-53


def columns_of(settings: Settings, tree: int, seed: int, n: int) -> np.ndarray:
    """Which features a tree may split on: the share of least hashes, one at least."""
    order = np.argsort(_uniform(np.arange(n, dtype=np.uint64), tree, seed + 1), kind="stable")
    allowed = np.zeros(n, bool)
    allowed[order[: max(1, int(settings.colsample_bytree * n + 1e-9))]] = True
    return allowed


def pack(
    df: DataFrame, features: Sequence[Column], label: Column, key: Column, path: str, fold: Column | None = None, bins: int = BINS
) -> Blocks:
    """Bin and pack the rows below ``path``.

    A feature is missing where NULL or NaN. ``key`` is a 64-bit whole number that
    names a row: rows with equal keys are drawn together.
    """
    spark = df.sparkSession
    fold = F.lit(-1) if fold is None else fold
    # Every row starts at the same log-odds, so all second derivatives are equal: the cuts weigh rows alike.
    found = summaries(df, list(features))
    cuts = [found[i].cuts(bins) for i in range(len(features))]
    missing = max((len(c) for c in cuts), default=0) + 1
    kind = np.dtype("<u1" if missing < 256 else "<u2")
    named = df.select(
        label.cast("int").alias("label"), fold.cast("int").alias("fold"), key.cast("long").alias("key"),
        *(c.cast("double").alias(f"v{i}") for i, c in enumerate(features)),
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= BLOCK:
                yield packed(waiting)
                waiting = []
        if waiting:
            yield packed(waiting)

    def packed(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(some)
        n = len(table)
        binned = np.empty((len(cuts), n), kind)
        for i, own in enumerate(cuts):
            values = table[f"v{i}"].to_numpy()
            binned[i] = np.where(np.isnan(values), missing, np.searchsorted(own, values, "left"))
        columns = [binned, table["label"].to_numpy().astype("<i1"), table["fold"].to_numpy().astype("<i4"), table["key"].to_numpy().astype("<i8")]
        return pa.record_batch(
            [pa.array([n], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.array([b""], pa.binary())],
            names=["n", "bins", "label", "fold", "draw", "margins"],
        )

    named.mapInArrow(blocks, _BLOCKS).write.mode("overwrite").parquet(f"{path}/blocks")
    counts = df.groupBy(fold.cast("int").alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.sum(label.cast("long")).alias("p")).collect()
    table = _few_a_batch(spark).read.schema(_BLOCKS).parquet(f"{path}/blocks")
    parts = _parts(table, sum(r.n for r in counts))
    return Blocks(
        table.coalesce(max(1, parts)), cuts, parts, {r.fold: r.p or 0 for r in counts}, {r.fold: r.n for r in counts}, path
    )


def _parts(table: DataFrame, rows: int) -> int:
    """Tasks of a level: as many as the cores, more only where each has ``ROWS_A_TASK`` rows, whatever the files are."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return min(table.rdd.getNumPartitions(), max(cores, -(-rows // ROWS_A_TASK)))


def _few_a_batch(spark: SparkSession) -> SparkSession:
    """A session whose Arrow batches hold few rows: a block is large."""
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_BLOCKS))
    return own


@dataclass
class _Fitting:
    """A model that is being fitted: its trees whose margins are not written yet, and the tree at hand."""

    model: Model
    pending: list[Tree] = field(default_factory=list)
    tree: Tree | None = None
    allowed: np.ndarray | None = None


class _Rows:
    """One block of rows, as a task sees it."""

    def __init__(self, row: dict, shared: dict):
        self.n = row["n"]
        n_features = len(shared["sizes"])
        kind = np.dtype("<u1" if shared["missing"] < 256 else "<u2")
        self.bins = np.frombuffer(row["bins"], kind).reshape(n_features, self.n)
        self.label = np.frombuffer(row["label"], "<i1")
        self.fold = np.frombuffer(row["fold"], "<i4")
        self.draw = np.frombuffer(row["draw"], "<u8")
        fits = shared["fits"]
        self.fits, self.missing = fits, shared["missing"]
        self.margins = np.frombuffer(row["margins"], "<f8").reshape(len(fits), self.n) if row["margins"] else None

    def margin(self, i: int, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Log-odds by model ``i`` of the rows ``at``, whose bins are ``bins``."""
        model = self.fits[i].model
        margin = np.full(len(at), model.start) if self.margins is None else self.margins[i, at]
        for tree in self.fits[i].pending:
            margin += (model.settings.learning_rate * tree.value)[tree.nodes(bins, self.missing)]
        return margin


def _rows_of(batches: Iterator[pa.RecordBatch], shared: dict) -> Iterator[tuple[dict, _Rows]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, _Rows(row, shared)


def _level_sums(shared: dict):
    """The function for ``mapInArrow`` that adds up derivatives by model, node of the level, feature and bin."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, level, missing = shared["fits"], shared["level"], shared["missing"]
        first, count = (1 << level) - 1, 1 << level
        cells = count * (missing + 1)
        total: dict[int, np.ndarray] = {}
        for _, rows in _rows_of(batches, shared):
            u: dict[float, np.ndarray] = {}
            for i, fit in enumerate(fits):
                settings = fit.model.settings
                if level and (level >= settings.max_depth or not (fit.tree.feature[first >> 1 : first] >= 0).any()):
                    continue
                chosen = rows.fold != settings.fold if settings.fold >= 0 else np.ones(rows.n, bool)
                if settings.subsample < 1:
                    if settings.subsample not in u:
                        u[settings.subsample] = _uniform(rows.draw, shared["number"], shared["seed"]) < settings.subsample
                    chosen = chosen & u[settings.subsample]
                at = np.flatnonzero(chosen)
                bins = rows.bins[:, at]
                start = 0
                if level:
                    node = fit.tree.nodes(bins, missing) - first
                    within = node >= 0
                    if not within.all():
                        at, bins, node = at[within], bins[:, within], node[within]
                    start = node * (missing + 1)
                p = 1 / (1 + np.exp(-rows.margin(i, at, bins)))
                derivatives = np.rint((p - rows.label[at]) * UNIT), np.rint(p * (1 - p) * UNIT)
                # Only features that the tree may split on are added up.
                found = []
                for own in bins[fit.allowed]:
                    cell = own + start
                    found.append([np.bincount(cell, d, cells) for d in derivatives])
                total[i] = total.get(i, 0) + np.array(found).astype(np.int64)
        part = TaskContext.get().partitionId()
        for i, summed in total.items():
            yield pa.record_batch(
                [pa.array([i], pa.int32()), pa.array([part], pa.int64()), pa.array([summed.tobytes()], pa.binary())], names=["fit", "part", "sums"]
            )

    return sums


_SUMS = "fit int, part long, sums binary"
_SPLITS = (
    "fit int, node int, feature int, bin int, missing_left boolean, gain double, value double, left double, right double"
)


def _added(table: pa.Table) -> np.ndarray:
    total = 0
    for data in table["sums"]:
        total = total + np.frombuffer(data.as_buffer(), "<i8")
    return total


def _merge(table: pa.Table) -> pa.Table:
    return pa.table({
        "fit": table["fit"][:1], "part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int64()),
        "sums": pa.array([_added(table).tobytes()], pa.binary()),
    })


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def best_split(sums: np.ndarray, sizes: np.ndarray, settings: Settings) -> tuple:
    """feature, bin, missing_left, gain, and the weights of the node and its children; feature -1 without a split.

    ``sums`` has gradients and second derivatives by feature and bin, the last bin for missing values.
    """
    g, h = sums.astype(np.float64) / UNIT
    total_g, total_h = sums[0, 0].sum() / UNIT, sums[1, 0].sum() / UNIT

    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return soft(g, settings.reg_alpha) ** 2 / (h + settings.reg_lambda)

    def weight(g: float, h: float) -> float:
        return float(-soft(np.float64(g), settings.reg_alpha) / (h + settings.reg_lambda)) if h + settings.reg_lambda else 0.0

    own = weight(total_g, total_h)
    whole = np.cumsum(sums[:, :, :-1], axis=2) / UNIT
    # Sides by direction (missing right, missing left), feature and bin.
    left_g = np.stack([whole[0], whole[0] + g[:, -1:]], axis=2)
    left_h = np.stack([whole[1], whole[1] + h[:, -1:]], axis=2)
    right_g, right_h = total_g - left_g, total_h - left_h
    least = max(settings.min_child_weight, 0.5 / UNIT)
    able = (left_h >= least) & (right_h >= least)
    able &= (np.arange(whole.shape[2])[None, :] < sizes[:, None])[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = np.where(able, gain(left_g, left_h) + gain(right_g, right_h) - gain(total_g, total_h), -np.inf)
    at = int(np.argmax(gains))
    if not gains.size or not gains.flat[at] > _LEAST_GAIN:
        return -1, 0, False, 0.0, own, 0.0, 0.0
    feature, bin_, side = np.unravel_index(at, gains.shape)
    place = feature, bin_, side
    return (
        int(feature), int(bin_), bool(side), float(gains[place]), own,
        weight(left_g[place], left_h[place]), weight(right_g[place], right_h[place]),
    )


def _split_nodes(shared: dict):
    """The function for ``applyInArrow`` that adds up a model's sums and splits each node of the level."""

    def split(table: pa.Table) -> pa.Table:
        i, level, missing = table["fit"][0].as_py(), shared["level"], shared["missing"]
        fit, first = shared["fits"][i], (1 << level) - 1
        features = np.flatnonzero(fit.allowed)
        # By derivative, node, feature and bin.
        sums = _added(table).reshape(len(features), 2, 1 << level, missing + 1).transpose(1, 2, 0, 3)
        rows = [(i, first + k, *best_split(sums[:, k], shared["sizes"][features], fit.model.settings)) for k in range(1 << level)]
        rows = [(i, node, int(features[f]) if f >= 0 else f, *rest) for i, node, f, *rest in rows]
        names = ["fit", "node", "feature", "bin", "missing_left", "gain", "value", "left", "right"]
        kinds = [pa.int32()] * 4 + [pa.bool_()] + [pa.float64()] * 4
        return pa.table({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows, strict=True), strict=True)})

    return split


def fits_at_once(blocks: Blocks, depth: int) -> int:
    """Models whose histograms of one level fit a task's memory."""
    a_model = (1 << max(0, depth - 1)) * max(1, len(blocks.cuts)) * (blocks.missing + 1) * 16
    return max(1, HISTOGRAM_BYTES // a_model)


def fit_all(blocks: Blocks, settings: Iterable[Settings], seed: int) -> Iterator[list[Model]]:
    """Fit the models side by side and hand them on as they end: those of few trees first."""
    fits = [_Fitting(Model(s, blocks.start(s.fold), blocks.cuts)) for s in settings]
    state, number = blocks.table, 0
    ended = [f.model for f in fits if f.model.settings.n_estimators <= 0]
    fits = [f for f in fits if f.model.settings.n_estimators > 0]
    if ended:
        yield ended
    while fits:
        _grow(blocks, state, fits, number, seed)
        number += 1
        ended = [f for f in fits if f.model.settings.n_estimators <= number]
        rest = [f for f in fits if f.model.settings.n_estimators > number]
        if rest and (ended or max(len(f.pending) for f in rest) >= TREES_A_STATE):
            state = _written_margins(blocks, state, fits, rest, number)
        fits = rest
        if ended:
            yield [f.model for f in ended]


def _shared(blocks: Blocks, fits: list[_Fitting], **more) -> dict:
    # The models' finished trees stay on the driver: tasks need the pending ones only.
    light = [_Fitting(Model(f.model.settings, f.model.start, []), f.pending, f.tree, f.allowed) for f in fits]
    return {"fits": light, "missing": blocks.missing, "sizes": np.array([len(c) for c in blocks.cuts]), **more}


def _grow(blocks: Blocks, state: DataFrame, fits: list[_Fitting], number: int, seed: int) -> None:
    """The next tree of every model, level by level."""
    for fit in fits:
        fit.tree = Tree.leaf(fit.model.settings.max_depth, 0.0)
        fit.allowed = columns_of(fit.model.settings, number, seed, len(blocks.cuts))
    for level in range(max(f.model.settings.max_depth for f in fits)):
        shared = _shared(blocks, fits, level=level, number=number, seed=seed)
        sums = state.mapInArrow(_level_sums(shared), _SUMS)
        parts = blocks.parts
        while parts > FAN_IN:
            sums = sums.groupBy("fit", F.floor(F.col("part") / FAN_IN)).applyInArrow(_merge, _SUMS)
            parts = -(-parts // FAN_IN)
        # One row for each model and node of the level.
        for row in sums.groupBy("fit").applyInArrow(_split_nodes(shared), _SPLITS).collect():
            tree = fits[row.fit].tree
            if row.node and tree.feature[(row.node - 1) // 2] < 0:
                continue
            if level == 0:
                tree.value[0] = row.value
            if row.feature >= 0 and level < fits[row.fit].model.settings.max_depth:
                tree.feature[row.node], tree.bin[row.node], tree.missing_left[row.node] = row.feature, row.bin, row.missing_left
                tree.gain[row.node] = row.gain
                tree.value[2 * row.node + 1], tree.value[2 * row.node + 2] = row.left, row.right
    for fit in fits:
        fit.tree.prune(fit.model.settings.gamma)
        fit.model.trees.append(fit.tree)
        fit.pending.append(fit.tree)
        fit.tree = None


def _written_margins(blocks: Blocks, state: DataFrame, fits: list[_Fitting], rest: list[_Fitting], number: int) -> DataFrame:
    """The blocks with the margins of the models in ``rest``, as a table; nothing is pending then."""
    shared = _shared(blocks, fits)
    keep = [i for i, f in enumerate(fits) if f in rest]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, rows in _rows_of(batches, shared):
            margins = np.stack([rows.margin(i, np.arange(rows.n), rows.bins) for i in keep])
            yield pa.RecordBatch.from_pylist([row | {"margins": margins.tobytes()}], schema=_block_schema())

    path = f"{blocks.path}/margins-{id(fits)}-{number}"
    state.mapInArrow(add, _BLOCKS).write.mode("overwrite").parquet(path)
    for fit in rest:
        fit.pending = []
    return state.sparkSession.read.schema(_BLOCKS).parquet(path).coalesce(max(1, blocks.parts))


def _block_schema() -> pa.Schema:
    return pa.schema([("n", pa.int32()), *((c, pa.binary()) for c in ("bins", "label", "fold", "draw", "margins"))])


def held_out_scores(blocks: Blocks, models: list[Model]) -> list[float | None]:
    """Of each model the AUC of its 0/1 predictions on its own fold; None where that lacks a class."""
    fits = [_Fitting(m, m.trees) for m in models]
    shared = _shared(blocks, fits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), 4), np.int64)
        for _, rows in _rows_of(batches, shared):
            for i, fit in enumerate(fits):
                own = np.flatnonzero(rows.fold == fit.model.settings.fold)
                positive, called = rows.label[own] == 1, rows.margin(i, own, rows.bins[:, own]) > 0
                total[i] += [positive.sum(), (positive & called).sum(), (~positive).sum(), (~positive & ~called).sum()]
        yield pa.record_batch([pa.array(range(len(models)), pa.int32()), *(pa.array(c) for c in total.T)], names=["fit", "p", "tp", "n", "tn"])

    sums = blocks.table.mapInArrow(count, "fit int, p long, tp long, n long, tn long").groupBy("fit").agg(
        *(F.sum(c).alias(c) for c in ("p", "tp", "n", "tn"))
    )
    scores: list[float | None] = [None] * len(models)
    for row in sums.collect():  # one row a model
        if row.p and row.n:
            scores[row.fit] = (row.tp / row.p + row.tn / row.n) / 2
    return scores

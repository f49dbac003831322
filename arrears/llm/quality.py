"""Quality scores learnt from preference pairs (Bradley-Terry).

A text becomes numbers that do not depend on its topic: shares of character
kinds, word lengths, repetition of words and lines, length. Logistic loss on the
difference of the numbers of a good row and a bad one, averaged over all such
pairs of the labelled rows, gives weights; the score of a text is its weighted
sum. The cut lies at the quantile of the learnt rows' scores that equals the share
of bad ones. A score is then mapped to 0..1 so that the cut falls on ``THRESHOLD``.

No pair is formed. The loss of a pair depends on the difference of two scores
only, and smoothly: scores are cut into panels of width ``PANEL``, a row is dealt
to the ``NODES`` interpolation points of its panel, and sums over all pairs are
sums over pairs of points (relative error some 1e-11). So a Newton step takes two
passes over the labelled rows, each of which adds up numbers of bounded size in
every task. What is added is whole numbers: the same rows in other files or
another order give the same model, to the last digit. Up to ``LOCAL_ROWS`` rows
are added up on the driver, more by Spark, with the same result.

Fitting covers all labelled rows, scoring every row, whole texts, in one pass
without a shuffle. Labels, language, source and id are never inputs. A null text
is scored as an empty one.
If the labelled rows lack one of the two classes, every score is 0.5: there is
nothing to prefer, and no text is rejected. Several labels of one id count as
the lowest; a null label does not count. Of several rows of a labelled id the fit
takes one, by the hash of its text.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.tables import column, fresh, ship, written
from arrears.llm.words import CHUNKS, bytes_of, byte_table, find_words, slices

THRESHOLD = 0.3
PENALTY = 1e-3
#: Labelled rows that are added up on the driver.
LOCAL_ROWS = 20_000
#: Bits of the array that rows without a label are left out by before their numbers are found.
FILTER_BITS = 24
#: Width of a panel of scores, and its interpolation points.
PANEL, NODES = 2.0, 14
#: Numbers of a row are multiples of 1 / _Z, weights of 1 / _W, shares of a point of 1 / _SHARE ** 2:
#: then every sum below is one of whole numbers under 2 ** 53, in any order.
_Z, _W, _SHARE = 1 << 16, 1 << 20, 1 << 15
_LIMIT = 8
#: Rows that are added up at a time.
_CHUNK = 1 << 14
#: Partial sums that one task merges.
_FAN_IN = 32

_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
#: Kind of each byte: upper, lower, digit, non-ASCII, space, line end, then each ASCII sign by itself.
_KIND = np.full(256, 4, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:], _KIND[10] = 0, 1, 2, 3, 5
for _i, _b in enumerate(_PUNCTUATION):
    _KIND[_b] = 6 + _i
N_KINDS = 6 + len(_PUNCTUATION)
_LINES = byte_table(lambda b: b not in (10, 13))
#: Added to every denominator, so that a short text shows little of any habit.
_PRIOR = 20.0


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def _repeated(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: words that occurred before in it, and words equal to the one before."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    again = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        a, b = order[:-1], order[1:]
        again[b] = (hashes[a] == hashes[b]) & (text[a] == text[b])
    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    return _per_text(again, first), _per_text(stutter, first)


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers for each text."""
    data, offsets = bytes_of(texts)
    n = len(texts)
    size = np.diff(offsets).astype(np.float64)
    kind = np.repeat(np.arange(n) * N_KINDS, np.diff(offsets)) + _KIND[data]
    kinds = np.bincount(kind, minlength=n * N_KINDS).reshape(n, N_KINDS).astype(np.float64)
    words = find_words(texts, CHUNKS)
    n_words = np.diff(words.first).astype(np.float64)
    length = _per_text(words.end - words.start, words.first)
    again, stutter = _repeated(words.hash, words.first)
    lines = find_words(texts, _LINES)
    n_lines = np.diff(lines.first).astype(np.float64)
    line_again, _ = _repeated(lines.hash, lines.first)
    letters = kinds[:, 0] + kinds[:, 1]
    signs = kinds[:, 6:]
    return np.column_stack([
        np.sqrt(kinds / (size + _PRIOR)[:, None]),
        np.sqrt(signs / (n_words + _PRIOR)[:, None]),
        np.sqrt(signs.sum(axis=1) / (n_words + _PRIOR)),
        kinds[:, 0] / (letters + _PRIOR),
        length / (n_words + 1),
        again / (n_words + _PRIOR),
        np.sqrt(stutter / (n_words + _PRIOR)),
        line_again / (n_lines + 2),
        np.log1p(size),
    ])


@dataclass
class Preference:
    """Weights on standardised numbers and the cut; ``score`` gives 0..1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    threshold: float = THRESHOLD

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Standardised numbers as multiples of 1 / ``_Z``."""
        return np.rint(np.clip((x - self.mean) / self.scale, -_LIMIT, _LIMIT) * _Z)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights / _Z

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(x), 0.5)
        at = np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + at, -30, 30)))


#: Sums by key. A step gives those of some rows, from their numbers and whether they are good.
Sums = dict[int, np.ndarray]
Step = Callable[[np.ndarray, np.ndarray], Sums]
#: Adds up a step over all rows, by a function of two arrays.
Total = Callable[..., Sums]


def _added(parts: Iterable[Sums], add: Callable = np.add) -> Sums:
    total: Sums = {}
    for part in parts:
        for key, value in part.items():
            total[key] = add(total[key], value) if key in total else value
    return total


def _ranges(x: np.ndarray, good: np.ndarray) -> Sums:
    return {0: np.concatenate([x.max(axis=0), -x.min(axis=0)])} if len(x) else {}


def _spread(low: np.ndarray, width: np.ndarray) -> Step:
    """Rows by class, sums of each column and of its squares, on a scale of 2 ** 26 steps from its least value to its greatest."""

    def step(x: np.ndarray, good: np.ndarray) -> Sums:
        u = np.rint((x - low) / width * (1 << 26)).astype(np.int64)
        square = u * u
        sums = np.stack([u.sum(axis=0), (square >> 26).sum(axis=0), (square & ((1 << 26) - 1)).sum(axis=0)])
        return {0: np.array([np.count_nonzero(~good), np.count_nonzero(good)]), 1: sums}

    return step


_POINTS = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)
_HEIGHT = np.array([1 / np.prod(np.delete(p - _POINTS, i)) for i, p in enumerate(_POINTS)])


def _shares(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Panel of each score, and its share of each of the panel's points (Lagrange polynomials).

    Column by column, as products of matrices may round one row differently among other rows.
    """
    panel = np.floor(score / PANEL)
    t = 2 * (score / PANEL - panel) - 1
    before, after = np.ones((NODES, len(t))), np.ones((NODES, len(t)))
    for i in range(1, NODES):
        before[i] = before[i - 1] * (t - _POINTS[i - 1])
        after[-1 - i] = after[-i] * (t - _POINTS[-i])
    return panel.astype(np.int64), before * after * _HEIGHT[:, None]


def _moments(model: Preference) -> Step:
    """Rows and sums of their numbers at each point, by 2 * panel + class, in a high and a low part."""

    def step(x: np.ndarray, good: np.ndarray) -> Sums:
        z = model.standard(x)
        panel, shares = _shares(z @ model.weights / _Z)
        key = 2 * panel + good
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        high = np.floor(shares * _SHARE)
        low = np.rint((shares * _SHARE - high) * _SHARE)
        rows = np.column_stack([np.ones(len(z)), z])[order]
        high, low = high[:, order], low[:, order]
        last = [*first[1:], len(order)]
        return {
            int(k): np.stack([high[:, a:b] @ rows[a:b], low[:, a:b] @ rows[a:b]]).astype(np.int64)
            for k, a, b in zip(keys, first, last, strict=True)
        }

    return step


def _curvature(model: Preference, at_points: Sums) -> Step:
    """Sums of the products of two numbers by class, weighted by what ``at_points`` gives a row's score."""

    def step(x: np.ndarray, good: np.ndarray) -> Sums:
        z = model.standard(x)
        panel, shares = _shares(z @ model.weights / _Z)
        key = 2 * panel + good
        keys, inverse = np.unique(key, return_inverse=True)
        table = np.stack([at_points[int(k)] for k in keys])
        weight = np.zeros(len(z))
        for i in range(NODES):
            weight += shares[i] * table[inverse, i]
        left = np.rint(weight[:, None] * z)
        right = np.rint(z / 16)
        return {side: (left[good == side].T @ right[good == side]).astype(np.int64) for side in (0, 1)}

    return step


def _derivatives(moments: Sums, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, Sums]:
    """Means over all pairs of the loss's gradient and of the cross part of its second derivative, and the points' weights."""
    keys = [sorted(k for k in moments if k % 2 == side) for side in (0, 1)]
    at = [np.concatenate([(k // 2 + (_POINTS + 1) / 2) * PANEL for k in side]) for side in keys]
    rows, sums = [], []
    for side in (0, 1):
        whole = np.concatenate([moments[k][0] / _SHARE + moments[k][1] / _SHARE**2 for k in keys[side]]) / counts[side]
        rows.append(whole[:, 0])
        sums.append(whole[:, 1:] / _Z)
    width = sums[0].shape[1]
    gradient, cross = np.zeros(width), np.zeros((width, width))
    heights = [np.zeros(len(side)) for side in at]
    # Some good points at a time against all bad ones.
    for a in range(0, len(at[1]), 512):
        b = slice(a, a + 512)
        wrong = 1 / (1 + np.exp(np.clip(at[1][b, None] - at[0], -700, 700)))
        steep = wrong * (1 - wrong)
        gradient += sums[1][b].T @ (wrong @ rows[0]) - sums[0].T @ (wrong.T @ rows[1][b])
        cross += sums[1][b].T @ steep @ sums[0]
        heights[1][b] = steep @ rows[0]
        heights[0] += steep.T @ rows[1][b]
    weights = {
        k: part for side in (0, 1) for k, part in zip(keys[side], np.split(heights[side], len(keys[side])), strict=True)
    }
    return gradient, cross + cross.T, weights


def _ranked(total: Total, model: Preference, ranks: list[int]) -> list[float]:
    """The scores of the given ranks, from 0: ranges are narrowed 16 bits at a time."""
    unit = _Z * _W
    low, bits = [-(1 << 53)] * len(ranks), 54
    while bits:
        bits = max(0, bits - 16)

        def step(x: np.ndarray, good: np.ndarray, low=tuple(low), bits=bits) -> Sums:
            score = np.rint(model.standard(x) @ model.weights * _W).astype(np.int64)
            cells = [(score - first) >> bits for first in low]
            return {i: np.bincount(cell[(cell >= 0) & (cell < 1 << 16)], minlength=1 << 16) for i, cell in enumerate(cells)}

        counts = total(step)
        for i, rank in enumerate(ranks):
            upto = np.cumsum(counts[i])
            cell = int(np.searchsorted(upto, rank, "right"))
            ranks = [*ranks[:i], rank - int(upto[cell] - counts[i][cell]), *ranks[i + 1 :]]
            low[i] += cell << bits
    return [first / unit for first in low]


def _fit(total: Total, width: int, penalty: float, threshold: float) -> Preference:
    """Newton steps on the logistic loss of the differences good - bad, over all pairs."""
    model = Preference(np.zeros(width), np.ones(width), np.zeros(width), 0.0, threshold)
    ranges = total(_ranges, np.maximum)
    if not ranges:
        return model
    low, span = -ranges[0][width:], ranges[0][:width] + ranges[0][width:]
    spread = total(_spread(low, np.where(span > 0, span, 1.0)))
    counts = spread[0]
    n = int(counts.sum())
    steps, high, rest = ([int(v) for v in part] for part in spread[1])
    squares = [(h << 26) + r for h, r in zip(high, rest, strict=True)]
    # Whole numbers of any size up to the last division.
    model.mean = low + span * np.array([u / (n << 26) for u in steps])
    scale = span * np.sqrt([(n * q - u * u) / (n * n << 52) for q, u in zip(squares, steps, strict=True)])
    model.scale = np.where(scale > 1e-9, scale, 1.0)
    if not counts.all():
        return model
    for _ in range(25):
        gradient, cross, weights = _derivatives(total(_moments(model)), counts)
        products = total(_curvature(model, weights))
        own = sum(products[side] / counts[side] for side in (0, 1)) * 16 / _Z**2
        hessian = (own + own.T) / 2 - cross + penalty * np.eye(width)
        step = np.linalg.solve(hessian, gradient - penalty * model.weights)
        moved = model.weights + step / max(1.0, np.abs(step).max() / 2)
        # The optimum has no weight beyond 38: the penalty on it would exceed the loss of no weights.
        model.weights = np.clip(np.rint(moved * _W) / _W, -60, 60)
        if np.abs(step).max() < 1e-6:
            break
    at = min(max(int(counts[0]), 1), n - 1)
    model.cut = sum(_ranked(total, model, [at - 1, at])) / 2
    return model


def _chunks(x: np.ndarray, good: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for a in range(0, len(x), _CHUNK):
        yield x[a : a + _CHUNK], good[a : a + _CHUNK]


def fit_pairs(x: np.ndarray, good: np.ndarray, penalty: float = PENALTY, threshold: float = THRESHOLD) -> Preference:
    """The model of rows ``x``, from all pairs of a good one and a bad one."""

    def total(step: Step, add: Callable = np.add) -> Sums:
        return _added((step(*chunk) for chunk in _chunks(x, good)), add)

    return _fit(total, x.shape[1], penalty, threshold)


def fit_table(rows: DataFrame, width: int, penalty: float = PENALTY, threshold: float = THRESHOLD) -> Preference:
    """:func:`fit_pairs` of a table of ``x`` and ``label``: tasks add up, the driver sees sums only."""
    ship(rows.sparkSession)

    def total(step: Step, add: Callable = np.add) -> Sums:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunks = (chunk for batch in batches for chunk in _chunks(*_rows_of(batch, width)))
            found = _added((step(*chunk) for chunk in chunks), add)
            if found:
                part = TaskContext.get().partitionId()
                yield pa.record_batch([pa.array([part], pa.int64()), pa.array([pickle.dumps(found)], pa.binary())], names=["part", "sums"])

        def merge(table: pa.Table) -> pa.Table:
            found = _added((pickle.loads(data) for data in table["sums"].to_pylist()), add)
            part = table["part"][0].as_py() // _FAN_IN
            return pa.table({"part": pa.array([part], pa.int64()), "sums": pa.array([pickle.dumps(found)], pa.binary())})

        parts = rows.select("x", "label").mapInArrow(sums, "part long, sums binary")
        tasks = rows.rdd.getNumPartitions()
        while tasks > _FAN_IN:
            parts = parts.groupBy(F.floor(F.col("part") / _FAN_IN)).applyInArrow(merge, "part long, sums binary")
            tasks = -(-tasks // _FAN_IN)
        return _added((pickle.loads(row.sums) for row in parts.collect()), add)

    return _fit(total, width, penalty, threshold)


def _rows_of(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x, batch.column(1).to_numpy(zero_copy_only=False) == 1


def _as_floats(x: np.ndarray) -> pa.Array:
    offsets = np.arange(0, (len(x) + 1) * x.shape[1], x.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel(), pa.float64()))


def _filter(labelled: DataFrame) -> np.ndarray:
    """Bit array of fixed size, set where the hash of some labelled id falls."""
    bit = F.shiftrightunsigned(F.xxhash64("labelled_id"), 64 - FILTER_BITS).alias("bit")
    cells = labelled.select(bit).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(bit, 64) AS INT))")).alias("set")
    ).toPandas()
    array = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    array[cells["cell"].to_numpy(np.int64)] = cells["set"].to_numpy(np.int64)
    return array.view(np.uint64)


def labelled_rows(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``x`` and ``label`` of one row of ``docs`` for each id of ``labelled`` that is there.

    Texts are not shuffled: a bit array of the labelled ids, which lets few
    others through, precedes the numbers, and those are grouped and joined by id.
    """
    ship(docs.sparkSession)
    kind = docs.select(column(docs, id_col)).schema[0].dataType
    # The hash of an id is that of another type's equal value only by chance: then all rows are let through.
    comparable = kind == labelled.schema["labelled_id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(_filter(labelled)) if comparable else None

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared is not None:
                bit = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
                wanted = (shared.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                batch = batch.filter(pa.array(wanted))
            for part in slices(batch, 0):
                x = _as_floats(features(part.column(0)))
                yield pa.record_batch([x, part.column(1), part.column(3)], names=["x", "id", "hash"])

    return (
        docs.where(column(docs, id_col).isNotNull())
        .select(
            column(docs, text_col).alias("text"), column(docs, id_col).alias("id"),
            F.xxhash64(column(docs, id_col)).alias("place"), F.xxhash64(column(docs, text_col)).alias("hash"),
        )
        .mapInArrow(numbers, f"x array<double>, id {kind.simpleString()}, hash long")
        # One row of each id, so that a repeated one counts once; tasks reduce their own rows before the shuffle.
        .groupBy("id")
        .agg(F.min(F.struct("hash", "x")).alias("first"))
        .join(labelled, F.col("id") == F.col("labelled_id"))
        .select("first.x", F.col("label").cast("long").alias("label"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int | None = None,
) -> Preference:
    """Learn from all ``labels``, or from those ``max_labelled`` whose ids hash lowest if that is given."""
    labelled = (
        labels.where(column(labels, id_col).isNotNull() & column(labels, label_col).isNotNull())
        .groupBy(column(labels, id_col).alias("labelled_id"))
        .agg(F.min(column(labels, label_col)).alias("label"))
    )
    if max_labelled is not None:
        labelled = labelled.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(max_labelled)
    labelled = written(labelled, "quality-labels")
    rows = labelled_rows(docs, labelled, id_col, text_col)
    width = len(features(pa.array([""]))[0])
    if labelled.count() > LOCAL_ROWS:
        return fit_table(written(rows, "quality-numbers"), width)
    found = rows.toPandas()
    x = np.stack(found["x"].to_list()) if len(found) else np.zeros((0, width))
    return fit_pairs(x, found["label"].to_numpy() == 1)


def scored(docs: DataFrame, model: Preference, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col`` of 0 to 1, higher for better; it gets underscores if the name is taken."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)
    name = fresh(docs, score_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                scores = pa.array(model.score(features(part.column(at))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, "score"])

    scores = plain.mapInArrow(score, T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())]))
    return scores.toDF(*docs.columns, name)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that reach the threshold, with the columns of ``docs``."""
    model = fit(docs, labels, id_col, text_col)
    name = fresh(docs, "score")
    good = scored(docs, model, text_col, name).where(F.col(name) >= model.threshold)
    return good.select(*(column(good, c) for c in docs.columns))

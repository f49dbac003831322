"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

A token is a run of anything but white space, A-Z lower-cased; every text has one
end token more. A word belongs to one class: each of the most frequent words and
the end have a class of their own, all others go by their last two bytes. Then

    P(word | history) = P(class | history) * P(word | class)

The first factor is a softmax over the classes. Its features are hashed: the word
before, the two words before, the word before that one (a skip), and the classes
of the third and fourth word before. The second factor has the same features: the
words of a class by form hang in a binary tree of ``LEAVES`` leaves by the bits of
a hash, and each node of the path is a logistic choice between its sides,

    P(word | class, history) = P(side | node, history) * ... * P(word | leaf)

whose weights lie in one hashed table by history and node. A node without trained
weights chooses by the training counts below it. Only words that share a leaf are
told apart by their smoothed share of its count, with one place for unknown words,
so the probabilities of each history sum to 1.

Counts cover every training text. Weights are trained in rounds: each task takes
AdaGrad steps over its part of the round's texts, and the average of the tasks'
weights starts the next round; each training text is used once. The model has a
fixed size; counts do not, and stay distributed: the most common words' counts, a
fixed number, are sent to every task, all others are joined word by word.

Null texts count as empty: they have the end token alone. Equal rows are scored
each by itself. A null id is hashed as no text at all and is held out as
``held_out`` says. Without training texts every count is 0 and the classes are
equally likely. Words are known by 58 bits of hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.tables import column, ship, text_column, written
from arrears.llm.words import CHUNKS, Words, find_words, mix, slices

#: Classes by form, and words with classes of their own.
FORMS = 32
FREQUENT = 31
CLASSES = FORMS + FREQUENT + 1
ROWS = 1 << 12
TEMPLATES = 4
ALPHA = 0.1
RATE = 0.15
#: Leaves of a form class's tree, and weights of all nodes and histories together.
LEAF_BITS = 5
LEAVES = 1 << LEAF_BITS
CELLS_BITS = 20
CELLS = 1 << CELLS_BITS
#: Tokens in a training step, and in one of computing probabilities of classes and leaves, which is kinder to the cache.
STEP = 8192
SCORE_STEP = 1024
LEAF_SCORE_STEP = 4096
ROUNDS = 2
#: Parts that a table of weights is averaged in.
PIECES = 64
#: So many words and their counts go to every task; the others' counts are joined.
MOST_COMMON = 1 << 17
#: Words are looked up by so many first bits of their hashes.
INDEX_BITS = 18
#: Fixed value: the last class and the id of the end token.
END = CLASSES - 1
END_ID = np.uint64(2**64 - 1)


def word_ids(words: Words) -> np.ndarray:
    """Hash of each word, its low bits replaced by the class of its form."""
    last = words.low[words.end - 1].astype(np.uint64)
    before = words.low[np.maximum(words.end - 2, words.start)].astype(np.uint64)
    form = mix(last * np.uint64(256) + before) & np.uint64(FORMS - 1)
    return (words.hash & ~np.uint64(63)) | form


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts' tokens, each text followed by the end, and where each text begins."""
    words = find_words(texts, CHUNKS)
    first = words.first + np.arange(len(words.first))
    ids = np.empty(first[-1], np.uint64)
    is_end = np.zeros(len(ids), bool)
    is_end[first[1:] - 1] = True
    ids[is_end] = END_ID
    ids[~is_end] = word_ids(words)
    return ids, first


def classes_of(ids: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Class of each token; ``frequent`` is sorted."""
    out = (ids & np.uint64(FORMS - 1)).astype(np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, ids), len(frequent) - 1)
        out = np.where(frequent[at] == ids, FORMS + at, out)
    out[ids == END_ID] = END
    return out


def leaves_of(ids: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Leaf of each word of a form class, all classes' leaves numbered through."""
    return (classes << LEAF_BITS) | (mix(ids) >> np.uint64(64 - LEAF_BITS)).astype(np.int64)


def _paths() -> tuple[np.ndarray, np.ndarray]:
    """Of each level and leaf: the node there, all classes' nodes numbered through in heap order, and the side it takes."""
    leaf = np.arange(FORMS << LEAF_BITS)
    depth = np.arange(LEAF_BITS)[:, None]
    code = leaf & (LEAVES - 1)
    nodes = ((leaf >> LEAF_BITS) << LEAF_BITS) | (1 << depth) | (code >> (LEAF_BITS - depth))
    return nodes, (code >> (LEAF_BITS - 1 - depth)) & 1


NODES, SIDES = _paths()
MARKS = (NODES + 1).astype(np.uint32) * np.uint32(0x9E3779B1)


def node_bias(leaf_sums: np.ndarray) -> np.ndarray:
    """Log-odds of the upper side of each node, in heap order by form class, from what lies in the leaves."""
    bias = np.zeros((FORMS, LEAVES))
    sums = leaf_sums.reshape(FORMS, LEAVES)
    for level in reversed(range(LEAF_BITS)):
        sides = sums.reshape(FORMS, 1 << level, 2)
        bias[:, 1 << level : 2 << level] = np.log(sides[..., 1] / sides[..., 0])
        sums = sides.sum(axis=2)
    return bias.ravel().astype(np.float32)


@dataclass
class Model:
    frequent: np.ndarray  # ids, sorted
    bias: np.ndarray  # by class
    weights: np.ndarray  # template, row, class
    node_bias: np.ndarray  # by form class and node
    node_weights: np.ndarray  # by hash of history and node

    @classmethod
    def fresh(cls, frequent: np.ndarray, class_counts: np.ndarray, leaf_sums: np.ndarray | None = None) -> Model:
        share = (class_counts + 0.5) / (class_counts + 0.5).sum()
        leaf_sums = np.ones(FORMS * LEAVES) if leaf_sums is None else leaf_sums
        return cls(
            np.sort(frequent), np.log(share).astype(np.float32), np.zeros((TEMPLATES, ROWS, CLASSES), np.float32),
            node_bias(leaf_sums), np.zeros(CELLS, np.float32),
        )

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return classes_of(ids, self.frequent)

    def features(self, ids: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Row of each template for each token."""
        return _rows_of(self.histories(ids, classes, first))

    def histories(self, ids: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Hash of each template for each token; what lies before a text is one mark."""
        place = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
        back = []
        for k in range(1, 5):
            own = (ids if k < 3 else classes.astype(np.uint64) + np.uint64(1))
            moved = np.zeros(len(ids), np.uint64)
            moved[k:] = own[:-k] if k < len(own) + 1 else own[:0]
            back.append(np.where(place >= k, moved, np.uint64(0)))
        one, two, three, four = back
        return np.stack([
            mix(one + np.uint64(1)),
            mix(mix(one + np.uint64(2)) + two),
            mix(two + np.uint64(3)),
            mix(three * np.uint64(CLASSES + 1) + four + np.uint64(4)),
        ])

    @cached_property
    def path_bias(self) -> np.ndarray:
        """``node_bias`` of each node of a leaf's path and leaf."""
        return self.node_bias[NODES]

    def choices(self, leaves: np.ndarray, histories: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each node of a word's path and word: cells by template, log-odds of the upper side, whether it goes there."""
        marks = np.take(MARKS, leaves, axis=1)
        odds = np.take(self.path_bias, leaves, axis=1)
        cells = np.empty((len(histories), *marks.shape), np.int64)
        for own, history in zip(cells, (histories >> np.uint64(32)).astype(np.uint32), strict=True):
            mixed = history ^ marks
            mixed *= np.uint32(0x85EBCA6B)
            mixed >>= np.uint32(32 - CELLS_BITS)
            own[...] = mixed
            odds += np.take(self.node_weights, own)
        return cells, odds, np.take(SIDES, leaves, axis=1)

    def log10_leaves(self, leaves: np.ndarray, histories: np.ndarray) -> np.ndarray:
        """log10 P(leaf | class, history) of words of the form classes."""
        out = np.empty(len(leaves))
        for a in range(0, len(leaves), LEAF_SCORE_STEP):
            _, odds, up = self.choices(leaves[a : a + LEAF_SCORE_STEP], histories[:, a : a + LEAF_SCORE_STEP])
            # Log-odds are far below 100: the product of all nodes stays finite.
            out[a : a + LEAF_SCORE_STEP] = (1 + np.exp(np.where(up, -odds, odds))).prod(axis=0, dtype=np.float64)
        return -np.log10(out)

    def shares(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token what the classes have in proportion, and the sum of that."""
        z = np.take(self.weights[0], rows[0], axis=0)
        z += self.bias
        for table, row in zip(self.weights[1:], rows[1:], strict=True):
            z += np.take(table, row, axis=0)
        # Short rows have their argmax found faster than their max.
        z -= np.take_along_axis(z, z.argmax(axis=1)[:, None], axis=1)
        np.exp(z, out=z)
        return z, z.sum(axis=1)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Softmax over the classes for each token."""
        z, total = self.shares(rows)
        z /= total[:, None]
        return z

    def log10_classes(self, classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(classes))
        for a in range(0, len(classes), SCORE_STEP):
            z, total = self.shares(rows[:, a : a + SCORE_STEP])
            out[a : a + SCORE_STEP] = z[np.arange(len(z)), classes[a : a + SCORE_STEP]] / total
        return np.log10(np.maximum(out, 1e-30))


def _rows_of(histories: np.ndarray) -> np.ndarray:
    return (histories & np.uint64(ROWS - 1)).astype(np.uint16)


def _row_sums(rows: np.ndarray, begin: np.ndarray, order: np.ndarray | None = None, few: int = 32) -> np.ndarray:
    """Sum of each run of rows, taken in ``order``, that starts at ``begin``: all short runs together, long ones each by itself."""
    order = np.arange(len(rows)) if order is None else order
    size = np.diff(np.append(begin, len(order)))
    # Longest first, so that the runs with another row are always the first ones.
    by = np.argsort(-size)
    size, start = size[by], begin[by]
    sums = np.take(rows, order[start], axis=0)
    longer = np.searchsorted(-size, -np.arange(few + 1)).tolist()
    long = longer[few]
    for i in range(1, few):
        if longer[i] == long:
            break
        sums[long : longer[i]] += np.take(rows, order[start[long : longer[i]] + i], axis=0)
    for i in range(long):
        np.add.reduce(np.take(rows, order[start[i] : start[i] + size[i]], axis=0), axis=0, out=sums[i])
    out = np.empty_like(sums)
    out[by] = sums
    return out


class Trainer:
    """AdaGrad steps on a model of its own; ``seen`` counts the tokens."""

    def __init__(self, model: Model):
        self.model = Model(model.frequent, model.bias, model.weights.copy(), model.node_bias, model.node_weights.copy())
        self.squares = np.full_like(model.weights, 1.0)
        self.node_squares = np.full_like(model.node_weights, 1.0)
        self.seen = 0

    def learn(self, ids: np.ndarray, first: np.ndarray) -> None:
        classes = self.model.classes(ids)
        histories = self.model.histories(ids, classes, first)
        rows = _rows_of(histories)
        for a in range(0, len(ids), STEP):
            self._step(rows[:, a : a + STEP], classes[a : a + STEP])
        formed = np.flatnonzero(classes < FORMS)
        leaves = leaves_of(ids[formed], classes[formed])
        for a in range(0, len(formed), STEP):
            self._leaf_step(leaves[a : a + STEP], histories[:, formed[a : a + STEP]])
        self.seen += len(ids)

    def _leaf_step(self, leaves: np.ndarray, histories: np.ndarray) -> None:
        cells, odds, up = self.model.choices(leaves, histories)
        upper = 1 / (1 + np.exp(-odds))
        # Sorted by cell, all tables are walked in their order; the probability goes along in the low half, its sign is the side.
        keys = cells.view(np.uint64)
        keys <<= np.uint64(32)
        keys |= np.where(up, -upper, upper).view(np.uint32)
        keys = np.sort(keys, axis=None)
        cells = (keys >> np.uint64(32)).astype(np.uint32)
        last = np.flatnonzero(np.append(cells[1:] != cells[:-1], True))
        at = np.take(cells, last).astype(np.int64)
        parts = keys.astype(np.uint32).view(np.float32)
        off = np.subtract(np.abs(parts), np.signbit(parts), dtype=np.float64)
        gradient = np.diff(np.take(np.cumsum(off), last), prepend=0).astype(np.float32)
        square = np.take(self.node_squares, at)
        square += gradient * gradient
        self.node_squares[at] = square
        np.sqrt(square, out=square)
        gradient *= RATE
        gradient /= square
        self.model.node_weights[at] -= gradient

    def _step(self, rows: np.ndarray, classes: np.ndarray) -> None:
        off = np.empty((len(classes), CLASSES), np.float32)
        for a in range(0, len(classes), SCORE_STEP):
            z, total = self.model.shares(rows[:, a : a + SCORE_STEP])
            np.divide(z, total[:, None], out=off[a : a + SCORE_STEP])
        off[np.arange(len(off)), classes] -= 1
        for table, squares, row in zip(self.model.weights, self.squares, rows, strict=True):
            order = np.argsort(row, kind="stable")
            ordered = row[order]
            begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            gradient = _row_sums(off, begin, order)
            at = ordered[begin]
            square = np.take(squares, at, axis=0)
            square += gradient * gradient
            squares[at] = square
            np.sqrt(square, out=square)
            gradient /= square
            gradient *= RATE
            table[at] -= gradient


def _word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of a table with one column of texts; batches are summed before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens(part.column(0))[0] for part in slices(batch, 0)]
            word, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])

    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _most_common(counts: DataFrame, most: int) -> DataFrame:
    """Words above a count that at most ``most`` words reach.

    The count comes from a histogram of some thousand rows: sorting would send
    the most common words of every partition to one place.
    """
    step = F.floor(F.log2("n") * 32)
    sizes = {r.step: r.words for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()}
    taken, least = 0, float("inf")
    for at in sorted(sizes, reverse=True):
        taken += sizes[at]
        if taken > most:
            break
        least = at
    return counts.where(step >= F.lit(least))


def _cell_counts(counts: DataFrame, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each leaf, then of each class without leaves; as many rows at most come to the driver."""
    size = FORMS * LEAVES + CLASSES

    def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy().view(np.uint64)
            own = classes_of(ids, frequent)
            cell = np.where(own < FORMS, leaves_of(ids, own), FORMS * LEAVES + own)
            n += np.bincount(cell, batch.column(1).to_numpy(), minlength=size).astype(np.int64)
            v += np.bincount(cell, minlength=size)
        at = np.flatnonzero(v)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(n[at]), pa.array(v[at])], names=["cell", "n", "v"])

    rows = counts.mapInArrow(by_cell, "cell long, n long, v long").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    n, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
    found = rows.toPandas()
    n[found["cell"]], v[found["cell"]] = found["n"], found["v"]
    return n, v


def _round(texts: DataFrame, model: Model) -> Model:
    """Every task learns from its texts; the average of their weights, by tokens seen, is the new model."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value)
        for batch in batches:
            for part in slices(batch, 0, 2 << 20):
                trainer.learn(*tokens(part.column(0)))
        if trainer.seen:
            pieces = np.array_split(trainer.model.weights.ravel(), PIECES) + np.array_split(trainer.model.node_weights, PIECES)
            yield pa.record_batch(
                [pa.array(range(2 * PIECES), pa.int64()), pa.array([trainer.seen] * 2 * PIECES, pa.int64()),
                 pa.array([p.tobytes() for p in pieces], pa.binary())],
                names=["piece", "seen", "weights"],
            )

    def average(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0.0, 0
        for batch in groups:
            for n, weights in zip(batch.column("seen").to_pylist(), batch.column("weights").to_pylist(), strict=True):
                total = total + np.frombuffer(weights, np.float32) * np.float64(n)
                seen += n
        yield pa.record_batch(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())],
            names=["piece", "weights"],
        )

    parts = texts.mapInArrow(learn, "piece long, seen long, weights binary")
    # 2 * PIECES rows, the size of the model together.
    rows = parts.groupBy("piece").applyInArrow(average, "piece long, weights binary").collect()
    if not rows:
        return model
    flat = [np.frombuffer(r.weights, np.float32) for r in sorted(rows, key=lambda r: r.piece)]
    weights = np.concatenate(flat[:PIECES]).reshape(model.weights.shape)
    return Model(model.frequent, model.bias, weights, model.node_bias, np.concatenate(flat[PIECES:]))


def _index(words: np.ndarray) -> np.ndarray:
    """Where the words of each ``INDEX_BITS`` first bits begin; ``words`` is sorted."""
    return np.searchsorted(words, np.arange(1 << INDEX_BITS, dtype=np.uint64) << np.uint64(64 - INDEX_BITS))


def _find(words: np.ndarray, index: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each id in ``words``, and whether it is there; hashes leave few words to each of the first bits."""
    last = len(words) - 1
    if last < 0:
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    at = np.minimum(np.take(index, (ids >> np.uint64(64 - INDEX_BITS)).astype(np.int64)), last)
    behind = np.flatnonzero(np.take(words, at) < ids)
    while len(behind):
        behind = behind[at[behind] < last]
        at[behind] += 1
        behind = behind[words[at[behind]] < ids[behind]]
    return at, np.take(words, at) == ids


def _scan(
    rows: DataFrame, model: Model, words: np.ndarray, n: np.ndarray, leaf_sums: np.ndarray
) -> DataFrame:
    """Per document what the model and the common words give, and the words that are not common."""
    words = words.view(np.uint64)
    order = np.argsort(words)
    # What P(word | leaf) has besides log10(n + ALPHA).
    shared = rows.sparkSession.sparkContext.broadcast((model, words[order], np.log10(n[order] + ALPHA), -np.log10(leaf_sums)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, logs, spread = shared.value
        index = _index(words)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            # Small parts, whose arrays stay in the cache.
            for part in slices(batch, 2, 256 << 10):
                ids, first = tokens(part.column(2))
                at, is_common = _find(words, index, ids)
                log = np.where(is_common, np.take(logs, at), 0.0) if len(words) else np.zeros(len(ids))
                classes = model.classes(ids)
                histories = model.histories(ids, classes, first)
                factor = model.log10_classes(classes, _rows_of(histories)) - np.where(classes < FORMS, 0.0, log)
                formed = np.flatnonzero(classes < FORMS)
                leaves = leaves_of(ids[formed], classes[formed])
                factor[formed] += model.log10_leaves(leaves, histories[:, formed]) + spread[leaves]
                rare_first = np.concatenate([[0], np.cumsum(~is_common)])[first]
                rare = pa.ListArray.from_arrays(
                    pa.array(rare_first, pa.int32()), pa.array(ids[~is_common].view(np.int64))
                )
                columns = [
                    pa.array(np.arange(row, row + len(part)), pa.int64()), part.column(0), part.column(1),
                    pa.array(np.diff(first), pa.int64()), pa.array(_sums(is_common, first).astype(np.int64)),
                    pa.array(_sums(log, first)), pa.array(_sums(factor, first)), rare,
                ]
                row += len(part)
                yield pa.record_batch(
                    columns,
                    names=["row", "doc_id", "held_out", "n_tokens", "common_known", "common_log", "model_log", "rare"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, common_known long, common_log double,"
        " model_log double, rare array<long>",
    )


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum over the tokens of each text; every text has one at least."""
    return np.add.reduceat(values.astype(np.float64), first[:-1])


def language_scores(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    most_common: int = MOST_COMMON,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``held_out`` is a column of ``docs``; its rows are scored but not learnt from.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        column(docs, id_col).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_column(docs, text_col).alias("text"),
    )
    training = rows.where("NOT held_out")
    counts = written(_word_counts(training.select("text")), "word-counts")
    end = int(END_ID.astype(np.int64))
    top = counts.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = np.array(sorted(np.array([r.word for r in top], np.int64).view(np.uint64)), np.uint64)
    cell_n, cell_v = _cell_counts(counts, frequent)
    n, v = int(cell_n.sum()), int(cell_v.sum())
    leaf_n, leaf_v = cell_n[: FORMS * LEAVES], cell_v[: FORMS * LEAVES]
    class_n = cell_n[FORMS * LEAVES :] + np.append(leaf_n.reshape(FORMS, LEAVES).sum(axis=1), np.zeros(CLASSES - FORMS, np.int64))
    leaf_sums = leaf_n + ALPHA * (leaf_v + 1)
    model = Model.fresh(frequent, class_n, leaf_sums)
    for i in range(rounds):
        part = training.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == i)
        model = _round(part.select("text"), model)

    common = _most_common(counts, most_common).toPandas()
    table = written(_scan(rows, model, common["word"].to_numpy(np.int64), common["n"].to_numpy(np.int64), leaf_sums), "scores")
    rare = (
        table.select("row", F.explode("rare").alias("word"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + ALPHA)).alias("rare_log"), F.count("n").alias("rare_known"))
    )
    logs = F.col("common_log") + F.coalesce("rare_log", F.lit(0.0))
    whole = math.log10(n + ALPHA * (v + 1))
    return table.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("common_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (logs + F.col("model_log")).alias("score"),
    )

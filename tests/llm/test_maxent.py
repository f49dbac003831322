import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from awkward import AWKWARD, frame
from pyspark.sql import functions as F

from arrears.llm import maxent, queries
from arrears.llm.maxent import CLASSES, FORMS, Model, Trainer, language_scores, tokens

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*TOKEN.findall((text or "").translate(LOW)), None]


def base(docs, is_held):
    counts = Counter(w for (i, t), held in zip(docs, is_held, strict=True) if not held for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in docs:
        own = words(t)
        log = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        out.append((i, len(own), sum(counts[w] > 0 for w in own), n, log))
    return out


@pytest.mark.parametrize("most_common", [1, 5, 1 << 17])
def test_base_scores_and_counts(spark, most_common):
    held = [i is not None and i % 3 == 0 for i, _ in AWKWARD]
    df = frame(spark, AWKWARD)
    found = language_scores(df, F.col("doc_id") % 3 == 0, most_common=most_common).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=repr)
    for g, w in zip(got, sorted(base(AWKWARD, held), key=repr), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4])
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_no_rows_and_no_training_rows(spark):
    assert language_scores(frame(spark, []), F.lit(False)).count() == 0
    row = language_scores(frame(spark, [(1, "a b")]), F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score)


def test_probabilities_of_a_history_sum_to_one(monkeypatch):
    texts = pa.array([f"the cat {a} and the dog {b}" for a in ("sat", "ran") for b in ("ate", "hid", "won")] * 20)
    ids, first = tokens(texts)
    known, counts = np.unique(ids, return_counts=True)
    frequent = np.sort(known[known != maxent.END_ID][np.argsort(-counts[known != maxent.END_ID])][:4])
    blank = Model.fresh(frequent, np.zeros(CLASSES))
    class_n = np.bincount(blank.classes(known), counts, CLASSES)
    class_v = np.bincount(blank.classes(known), minlength=CLASSES)
    trainer = Trainer(Model.fresh(frequent, class_n))
    for _ in range(5):
        trainer.learn(ids, first)
    model = trainer.model
    p = model.probabilities(model.features(ids, model.classes(ids), first))
    own = model.classes(known)
    for row in p[:10]:
        total = 0.0
        for k in range(CLASSES):
            inside = counts[own == k]
            if k >= FORMS:
                total += row[k]
            else:
                whole = class_n[k] + 0.1 * (class_v[k] + 1)
                total += row[k] * ((inside + 0.1).sum() + 0.1) / whole
        assert total == pytest.approx(1, abs=1e-5)


def test_features_stop_at_the_beginning_of_a_text():
    alone, first = tokens(pa.array(["b c d e f"]))
    both, edges = tokens(pa.array(["x y z", "b c d e f"]))
    model = Model.fresh(np.zeros(0, np.uint64), np.zeros(CLASSES))
    a = model.features(alone, model.classes(alone), first)
    b = model.features(both, model.classes(both), edges)
    assert (a == b[:, edges[1] :]).all()


def test_order_of_words_is_learnt(spark):
    rows = [(i, " ".join(["red", "blue", "green", "white"] * 30)) for i in range(60)]
    rows += [(1000, "red blue green white red blue green white"), (1001, "blue blue red white green red green white")]
    scores = {r.doc_id: r.score for r in language_scores(frame(spark, rows), F.col("doc_id") >= 1000).collect()}
    assert scores[1000] > scores[1001] + 1


def test_query_beats_the_base_on_held_out_documents(spark, sf_dir):
    rows = queries.op6_maxent(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    held = [zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs]
    want = {w[0]: w for w in base([tuple(d) for d in docs], held)}
    for r in rows:
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
    out = [r for r in rows if r.held_out]
    assert len(out) == sum(held) and sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("n", [1, 2, 50, 3000])
def test_row_sums(n):
    rng = np.random.default_rng(n)
    rows = rng.random((n, 5), dtype=np.float32)
    begin = np.unique(np.concatenate([[0], rng.integers(0, n, n // 9 + 1)]))
    assert np.allclose(maxent._row_sums(rows, begin), np.add.reduceat(rows, begin, axis=0), rtol=1e-4)


def test_leaves_of_a_history_sum_to_one():
    ids, first = tokens(pa.array([f"cat{a}xy sees dog{b}xy" for a in range(9) for b in range(9)] * 5))
    trainer = Trainer(Model.fresh(np.zeros(0, np.uint64), np.zeros(CLASSES), np.random.default_rng(1).random(FORMS * maxent.LEAVES) + 0.1))
    trainer.learn(ids, first)
    model = trainer.model
    histories = model.histories(ids, model.classes(ids), first)
    for t in (0, 1, 2, 30):
        leaves = 5 * maxent.LEAVES + np.arange(maxent.LEAVES)
        p = 10 ** model.log10_leaves(leaves, np.repeat(histories[:, t : t + 1], maxent.LEAVES, axis=1))
        assert p.sum() == pytest.approx(1, abs=1e-5)


def test_leaf_bias_is_the_share_of_the_counts():
    sums = np.random.default_rng(2).random(FORMS * maxent.LEAVES) + 0.1
    model = Model.fresh(np.zeros(0, np.uint64), np.zeros(CLASSES), sums)
    leaves = np.array([0, 3, maxent.LEAVES - 1, 7 * maxent.LEAVES + 5])
    own = sums.reshape(FORMS, -1).sum(axis=1)[leaves >> maxent.LEAF_BITS]
    assert np.allclose(10 ** model.log10_leaves(leaves, np.ones((4, 4), np.uint64)), sums[leaves] / own, rtol=1e-4)


def test_history_tells_words_of_one_class_apart(spark):
    # 40 common words take the classes of their own; paxy and pbxy end alike and are as frequent.
    common = " ".join(f"common{i}" for i in range(40))
    rows = [(i, f"{common} {common} {'red paxy' if i % 2 else 'blue pbxy'}") for i in range(2000)]
    rows += [(5000, f"{common} red paxy"), (5001, f"{common} red pbxy")]
    scores = {r.doc_id: r.score for r in language_scores(frame(spark, rows), F.col("doc_id") >= 5000).collect()}
    assert scores[5000] > scores[5001] + 0.3


def test_a_leaf_step_takes_room_by_its_tokens_and_not_by_the_table():
    ids, first = tokens(pa.array(["some few words, and some of them twice"] * 3))
    trainer = Trainer(Model.fresh(np.zeros(0, np.uint64), np.zeros(CLASSES)))
    classes = trainer.model.classes(ids)
    histories = trainer.model.histories(ids, classes, first)
    formed = np.flatnonzero(classes < FORMS)
    leaves = maxent.leaves_of(ids[formed], classes[formed])
    cells, odds, up = trainer.model.choices(leaves, histories[:, formed])
    want = np.zeros(maxent.CELLS)
    np.add.at(want, cells, np.broadcast_to(1 / (1 + np.exp(-odds)) - up, cells.shape))
    tracemalloc.start()
    trainer._leaf_step(leaves, histories[:, formed])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < maxent.CELLS
    assert np.allclose(trainer.model.node_weights, -maxent.RATE * want / np.sqrt(1 + want**2), atol=1e-6)


def test_a_class_step_keeps_one_array_of_probabilities():
    rng = np.random.default_rng(4)
    classes = rng.integers(0, CLASSES, maxent.STEP)
    # Rows with one token, with some and with many; each sum is that of the tokens' own rows.
    rows = np.minimum(rng.zipf(1.3, (maxent.TEMPLATES, maxent.STEP)), maxent.ROWS - 1).astype(np.uint16)
    trainer = Trainer(Model.fresh(np.zeros(0, np.uint64), rng.integers(0, 99, CLASSES)))
    off = trainer.model.probabilities(rows).astype(np.float64)
    off[np.arange(len(off)), classes] -= 1
    want = np.zeros(trainer.model.weights.shape)
    for own, row in zip(want, rows, strict=True):
        np.add.at(own, row, off)
    tracemalloc.start()
    trainer._step(rows, classes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.9 * maxent.STEP * CLASSES * 4
    assert np.allclose(trainer.model.weights, -maxent.RATE * want / np.sqrt(1 + want**2), atol=1e-4)


def test_large_weights_neither_overflow_nor_vanish():
    model = Model.fresh(np.zeros(0, np.uint64), np.zeros(CLASSES))
    model.weights[0, 1] = -500
    model.weights[0, 2, 3] = 500
    rows = np.zeros((maxent.TEMPLATES, 3), np.uint16)
    rows[0] = [0, 1, 2]
    p = model.probabilities(rows)
    assert np.allclose(p[:2], 1 / CLASSES) and p[2, 3] == 1 and np.allclose(p.sum(axis=1), 1)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_words_are_found_by_the_first_bits(n):
    rng = np.random.default_rng(n)
    # Many share their first bits; the smallest and the largest id are asked for too.
    near = (np.uint64(5) << np.uint64(60)) + rng.integers(0, 60, 40).astype(np.uint64)
    words = np.unique(np.concatenate([rng.integers(0, 2**64, n, np.uint64), near, [maxent.END_ID]])[: n + 30 if n else 0])
    ids = np.concatenate([words, words + np.uint64(1), near, rng.integers(0, 2**64, 99, np.uint64), [np.uint64(0), maxent.END_ID]])
    at, found = maxent._find(words, maxent._index(words), ids)
    assert (found == np.isin(ids, words)).all()
    assert not found.any() or (words[at[found]] == ids[found]).all()

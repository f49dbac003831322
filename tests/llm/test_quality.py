import random

import numpy as np
import pyarrow as pa
import pytest
from awkward import AWKWARD, frame
from pyspark.sql import functions as F

from arrears.llm import quality, queries
from arrears.llm.quality import PENALTY, features, fit, fit_pairs, fit_table, keep_good, labelled_rows, scored


def corpus(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(["the", "of", "river", "house", "walks", "green", "and"]) for _ in range(rng.randrange(5, 80))]
        good = rng.random() < 0.8
        text = " ".join(words).capitalize() + "."
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), " | ".join(words), "$$$ ".join(words)])
        out.append((i, text, int(good)))
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus(400)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    return rows, frame(spark, [(i, t) for i, t, _ in rows]), labels


def test_held_out_rows_are_ranked_and_cut_right(spark, labelled):
    rows, docs, labels = labelled
    model = fit(docs, labels.where("doc_id % 4 <> 0"))
    got = {r.doc_id: r.score_ for r in scored(docs, model).collect()}
    held = [(got[i], q) for i, _, q in rows if i % 4 == 0]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([(s >= quality.THRESHOLD) == q for s, q in held]) > 0.95


def test_awkward_rows_keep_their_columns(spark, labelled):
    _, docs, labels = labelled
    model = fit(docs, labels)
    odd = frame(spark, AWKWARD)
    out = scored(odd, model)
    assert out.columns == [*odd.columns, "score_"] and out.count() == len(AWKWARD)
    assert out.where("score_ BETWEEN 0 AND 1").count() == len(AWKWARD)
    scores = {r.doc_id: r.score_ for r in out.where("doc_id < 4").collect()}
    assert scores[1] == scores[2]
    kept = keep_good(odd, labels.join(docs.select("doc_id"), "doc_id"))
    assert kept.columns == odd.columns


@pytest.mark.parametrize("where", ["quality = 1", "quality IS NULL", "doc_id < 0"])
def test_one_class_rejects_nothing(spark, labelled, where):
    _, docs, labels = labelled
    model = fit(docs, labels.where(where))
    assert {r[0] for r in scored(docs, model).select("score_").distinct().collect()} == {0.5}
    assert scored(docs.limit(0), model).count() == 0


def test_the_fit_takes_no_more_rows_than_its_bound(spark, labelled):
    _, docs, labels = labelled
    a, b = fit(docs, labels, max_labelled=50), fit(docs.repartition(5), labels.repartition(2), max_labelled=50)
    assert np.allclose(a.weights, b.weights) and a.cut == pytest.approx(b.cut)
    twice = labels.union(labels.withColumn("quality", F.lit(None).cast("int")))
    assert np.allclose(fit(docs, twice, max_labelled=50).weights, a.weights)


def test_a_repeated_labelled_id_counts_once(spark, labelled):
    _, docs, labels = labelled
    once = fit(docs, labels)
    hot = docs.where("doc_id = 3").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("copy")
    many = fit(docs.union(hot).repartition(7), labels)
    assert np.allclose(many.weights, once.weights) and many.cut == pytest.approx(once.cut)


def test_numbers_do_not_depend_on_the_neighbours():
    texts = ["A b. c", None, "x | y | z", "", "the the the\nthe the the\n"]
    whole = features(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.allclose(whole[i], features(pa.array([text], pa.string()))[0])


def test_fit_pairs_learns_the_difference():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    model = fit_pairs(x, x[:, 1] + 0.1 * rng.normal(size=500) > -0.5)
    assert np.argmax(np.abs(model.weights)) == 1 and model.weights[1] > 0


def all_pairs(x, good):
    """Weights and cut of the mean loss over every pair, pair by pair."""
    scale = x.std(axis=0)
    z = np.clip((x - x.mean(axis=0)) / np.where(scale > 1e-9, scale, 1), -8, 8)
    diff = (z[good][:, None] - z[~good][None]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + PENALTY * np.eye(len(w))
        w += np.linalg.solve(hessian, diff.T @ p / len(diff) - PENALTY * w)
    raw = np.sort(z @ w)
    return w, raw[(~good).sum() - 1 : (~good).sum() + 1].mean()


@pytest.mark.parametrize("noise", [0.1, 3.0])
def test_every_pair_counts(noise):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=(600, 6)) * [1, 30, 1, 0.01, 5, 1] + 9, np.full(600, 3.0)])
    good = x[:, 0] + x[:, 1] / 30 + noise * rng.normal(size=600) > 9
    weights, cut = all_pairs(x, good)
    model = fit_pairs(x, good)
    assert np.allclose(model.weights, weights, atol=3e-5) and model.cut == pytest.approx(cut, abs=2e-4)
    order = rng.permutation(600)
    again = fit_pairs(x[order], good[order])
    assert (again.weights == model.weights).all() and again.cut == model.cut


def test_tables_and_arrays_give_the_same_model(spark, labelled, monkeypatch):
    _, docs, labels = labelled
    here = fit(docs, labels)
    monkeypatch.setattr(quality, "LOCAL_ROWS", 0)
    there = fit(docs.repartition(40), labels.repartition(3))
    for name in ("mean", "scale", "weights"):
        assert (getattr(here, name) == getattr(there, name)).all()
    assert here.cut == there.cut and here.weights.any()


def test_sums_of_many_tasks_are_merged(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    good = x[:, 2] > 0.3
    rows = spark.createDataFrame([(r.tolist(), int(g)) for r, g in zip(x, good, strict=True)], "x array<double>, label long")
    here, there = fit_pairs(x, good), fit_table(rows.repartition(70), 3)
    assert (here.weights == there.weights).all() and here.cut == there.cut


def test_every_labelled_row_is_learnt_from(spark):
    n = 20_500
    docs = spark.range(n).selectExpr("id AS doc_id", "repeat('ab ', CAST(id % 50 AS INT)) AS text")
    model = fit(docs, docs.selectExpr("doc_id", "CAST(doc_id % 50 > 20 AS INT) AS quality"))
    x = features(pa.array(["ab " * (i % 50) for i in range(50)]))
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-6) and model.weights.any()


def test_ids_of_other_types_and_unlabelled_rows(spark, labelled):
    _, docs, labels = labelled
    small = labels.where("doc_id < 40").withColumn("doc_id", F.col("doc_id").cast("int"))
    lowest = small.selectExpr("doc_id AS labelled_id", "quality AS label")
    unknown = docs.union(frame(spark, [(None, "none"), (10**15, "far")]))
    assert labelled_rows(unknown, lowest, "doc_id", "text").count() == 40
    same = lowest.withColumn("labelled_id", F.col("labelled_id").cast("long"))
    assert labelled_rows(unknown, same, "doc_id", "text").count() == 40


def test_query_marks_its_held_out_fold(spark, sf_dir):
    import zlib

    rows = queries.op10_quality(spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) > 0.85

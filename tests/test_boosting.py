"""Boosted trees and the search against plain Python, hand-made trees and other layouts."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.operators import boosting, search
from arrears.operators.boosting import Settings, fit_all, held_out_scores, pack
from arrears.operators.model import SEARCH_SPACE, draw_candidates
from arrears.operators.quantiles import Summary, summaries


def frame(spark, n=600, files=3, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.choice([None, 0.0, 1.0, 2.0, 3.0]), round(rng.gauss(0, 1), 1), rng.choice([None, float("nan"), 5.0, 7.0])]
        odds = 0.6 * (x[0] or -1) + x[1] - (2 if x[2] == 7.0 else 0)
        rows.append((i, *x, int(rng.random() < 1 / (1 + math.exp(-odds))), i % 3))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int, fold int").repartition(files)


def blocks_of(df, path, **options):
    return pack(df, [F.col(c) for c in "abc"], F.col("label"), F.xxhash64("id"), str(path), F.col("fold"), **options)


def one(blocks, seed=88, **settings):
    (models,) = fit_all(blocks, [Settings(**settings)], seed)
    return models[0]


def scores(spark, df, model):
    inputs = [f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END" for c in "abc"]
    rows = df.select("id", F.expr(model.margin(inputs)).alias("m")).collect()
    return {r.id: r.m for r in rows}


def plain_margins(rows, s):
    """The same boosting on plain lists: every value is a cut."""
    clean = [[None if v is None or math.isnan(v) else v for v in r[1:4]] for r in rows]
    label = [r[4] for r in rows]
    share = sum(label) / len(label)
    margin = [math.log(share / (1 - share))] * len(rows)
    soft = lambda g: math.copysign(max(abs(g) - s.reg_alpha, 0), g)
    gain = lambda g, h: soft(g) ** 2 / (h + s.reg_lambda)
    for _ in range(s.n_estimators):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round((x - y) * 2**28) / 2**28 for x, y in zip(p, label)]
        h = [round(x * (1 - x) * 2**28) / 2**28 for x in p]

        def grow(members, depth):
            G, H = math.fsum(g[i] for i in members), math.fsum(h[i] for i in members)
            leaf = ("leaf", -soft(G) / (H + s.reg_lambda))
            best = (1e-6, None)
            if depth == s.max_depth:
                return leaf
            for f in range(3):
                for cut in sorted({clean[i][f] for i in range(len(rows)) if clean[i][f] is not None}):
                    for side in (False, True):
                        left = [i for i in members if (side if clean[i][f] is None else clean[i][f] <= cut)]
                        GL, HL = math.fsum(g[i] for i in left), math.fsum(h[i] for i in left)
                        if left and len(left) < len(members) and HL >= s.min_child_weight and H - HL >= s.min_child_weight:
                            gained = gain(GL, HL) + gain(G - GL, H - HL) - gain(G, H)
                            if gained > best[0] + 1e-9:
                                best = (gained, (f, cut, side, left))
            if best[1] is None:
                return leaf
            f, cut, side, left = best[1]
            sides = [grow(left, depth + 1), grow([i for i in members if i not in set(left)], depth + 1)]
            if best[0] < s.gamma and all(x[0] == "leaf" for x in sides):
                return leaf
            return ("split", f, cut, side, *sides)

        tree = grow(list(range(len(rows))), 0)
        for i in range(len(rows)):
            node = tree
            while node[0] == "split":
                v = clean[i][node[1]]
                node = node[4] if (node[3] if v is None else v <= node[2]) else node[5]
            margin[i] += s.learning_rate * node[1]
    return {r[0]: m for r, m in zip(rows, margin)}


@pytest.mark.parametrize("settings", [
    {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.5},
    {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "reg_alpha": 1.0, "reg_lambda": 2.0, "min_child_weight": 3.0},
    {"n_estimators": 2, "max_depth": 3, "learning_rate": 0.1, "gamma": 2.5, "reg_lambda": 0.0},
])
def test_equals_plain_boosting(spark, tmp_path, settings):
    df = frame(spark, 250)
    got = scores(spark, df, one(blocks_of(df, tmp_path), **settings))
    want = plain_margins([tuple(r) for r in df.collect()], Settings(**settings))
    assert got == pytest.approx(want, abs=1e-7)


def test_missing_rows_go_where_the_split_gains_more(spark, tmp_path):
    rows = [(i, 1.0 if i < 40 else 2.0 if i < 80 else None, 0.0, 0.0, int(i >= 40), 0) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int, fold int")
    tree = one(blocks_of(df, tmp_path / "right"), n_estimators=1, max_depth=1).trees[0]
    assert (tree.feature[0], tree.bin[0], tree.missing_left[0]) == (0, 0, False)
    flipped = df.withColumn("label", F.when(F.col("a").isNull(), 0).otherwise(F.col("label")))
    model = one(blocks_of(flipped, tmp_path / "left"), n_estimators=1, max_depth=1)
    assert (model.trees[0].feature[0], model.trees[0].bin[0], model.trees[0].missing_left[0]) == (0, 0, True)
    got = scores(spark, flipped, model)
    assert got[0] == got[99] < got[40]


def test_layout_does_not_change_a_model(spark, tmp_path, monkeypatch):
    settings = {"n_estimators": 6, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.6, "learning_rate": 0.1}
    few = frame(spark, files=3)
    first = scores(spark, few, one(blocks_of(few, tmp_path / "few"), **settings))
    many = few.orderBy("b").repartition(30)
    monkeypatch.setattr(boosting, "BLOCK", 7)
    monkeypatch.setattr(boosting, "FAN_IN", 4)
    monkeypatch.setattr(boosting, "TREES_A_STATE", 2)
    assert scores(spark, few, one(blocks_of(many, tmp_path / "many"), **settings)) == first
    assert scores(spark, few, one(blocks_of(few, tmp_path / "seed"), seed=89, **settings)) != first


def test_every_list_of_the_space_changes_the_model(spark, tmp_path):
    df = frame(spark)
    blocks = blocks_of(df, tmp_path)
    base = {name: values[0] for name, values in SEARCH_SPACE.items()} | {"n_estimators": 3, "max_depth": 3}
    other = {name: values[-1] for name, values in SEARCH_SPACE.items()} | {"n_estimators": 4, "max_depth": 2, "gamma": 5.0, "min_child_weight": 20}
    variants = [base, *({**base, name: other[name]} for name in SEARCH_SPACE)]
    models = [m for some in fit_all(blocks, [Settings(**v) for v in variants], 88) for m in some]
    by_settings = {m.settings: m for m in models}
    plain = scores(spark, df, by_settings[Settings(**base)])
    for name, variant in zip(SEARCH_SPACE, variants[1:], strict=True):
        assert scores(spark, df, by_settings[Settings(**variant)]) != plain, name


def test_many_fits_side_by_side_equal_single_ones(spark, tmp_path):
    blocks = blocks_of(frame(spark), tmp_path)
    wanted = [Settings(n_estimators=n, max_depth=d, fold=f, subsample=0.8) for n in (2, 5) for d in (1, 3) for f in (0, 1, -1)]
    groups = list(fit_all(blocks, wanted, 88))
    assert [{m.settings.n_estimators for m in g} for g in groups] == [{2}, {5}]
    for model in [m for g in groups for m in g]:
        alone = next(fit_all(blocks, [model.settings], 88))[0]
        assert model.margin("abc") == alone.margin("abc")


def test_held_out_scores_are_hard_auc_of_the_fold(spark, tmp_path):
    df = frame(spark)
    blocks = blocks_of(df, tmp_path)
    model = one(blocks, n_estimators=4, fold=1)
    margins = scores(spark, df, model)
    rows = [(r.label, margins[r.id] > 0) for r in df.where("fold = 1").collect()]
    recalls = [sum(y == c and p == bool(c) for y, p in rows) / sum(y == c for y, _ in rows) for c in (0, 1)]
    assert held_out_scores(blocks, [model]) == [pytest.approx(sum(recalls) / 2)]
    assert held_out_scores(blocks, [replace(model, settings=replace(model.settings, fold=9))]) == [None]


def test_awkward_matrices(spark, tmp_path):
    schema = "id long, a double, b double, c double, label int, fold int"
    same = spark.createDataFrame([(1, None, 1.0, None, 1, 0)] * 5 + [(1, None, 1.0, None, 0, 1)] * 5, schema)
    model = one(blocks_of(same, tmp_path / "same"), n_estimators=2)
    assert set(scores(spark, same, model).values()) == {0.0} and not model.importances().any()
    pure = same.where("label = 1")
    assert scores(spark, pure, one(blocks_of(pure, tmp_path / "pure"), n_estimators=1))[1] > 10
    empty = same.limit(0)
    assert one(blocks_of(empty, tmp_path / "empty"), n_estimators=1).trees[0].value[0] == 0


def test_a_search_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    blocks = blocks_of(frame(spark), tmp_path / "blocks")
    space = {"n_estimators": [2, 3], "max_depth": [1, 2], "reg_lambda": [1, 2]}
    candidates = draw_candidates(6, space)
    ledger = search.Ledger(spark, str(tmp_path / "ledger"), "rows", 88)
    whole = search.boosted_search(blocks, candidates)
    fitted = []
    plain = search.fit_all

    def counted(blocks, settings, seed):
        settings = list(settings)
        for models in plain(blocks, settings, seed):
            fitted.extend(m.settings for m in models)
            yield models
            if len(fitted) == 8:
                raise KeyboardInterrupt

    monkeypatch.setattr(search, "fit_all", counted)
    with pytest.raises(KeyboardInterrupt):
        search.boosted_search(blocks, candidates, ledger=ledger, at_once=4)
    assert len(ledger.known()) == len(fitted) == 8
    again = search.boosted_search(blocks, candidates, ledger=ledger, at_once=4)
    folds = [s for s in fitted if s.fold >= 0]
    assert len(folds) == len(set(folds)) == 18 and again.n_fits == 10
    assert again.scores == whole.scores and again.best == whole.best
    assert again.model.margin("abc") == whole.model.margin("abc")
    other = search.Ledger(spark, ledger.path, "other rows", 88)
    assert other.known() == {} and len(ledger.known()) == 18


def ranks(values, weights, at):
    return np.array([weights[values < v].sum() for v in at]), np.array([weights[values <= v].sum() for v in at])


@pytest.mark.parametrize("size", [8, 50, 400])
def test_rank_error_of_merged_summaries_against_a_sort(size):
    rng = np.random.default_rng(size)
    values = np.round(rng.gamma(0.5, 10, 5000), 2)
    weights = rng.random(5000)
    parts = [Summary.of(v, w).shortened(size) for v, w in zip(np.array_split(values, 40), np.array_split(weights, 40))]
    n_shortened = 1
    while len(parts) > 1:
        parts = [parts[i].merge(parts[i + 1]).shortened(size) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        n_shortened += 1
    (whole,) = parts
    below, upto = ranks(values, weights, whole.value)
    assert len(whole.value) <= size and whole.total == pytest.approx(weights.sum())
    assert (whole.low <= below + 1e-9).all() and (whole.high >= upto - 1e-9).all()
    assert whole.rank_error() <= n_shortened / (size - 1)
    bins = 5
    cuts = whole.cuts(bins)
    below, upto = ranks(values, weights, cuts[:-1])
    wanted = np.arange(1, bins) * weights.sum() / bins
    if len(cuts) == bins:
        assert (np.maximum(below - wanted, wanted - upto) <= (whole.rank_error() + 1e-9) * weights.sum()).all()


def test_summaries_in_one_pass_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr("arrears.operators.quantiles.FAN_IN", 3)
    df = spark.range(20_000, numPartitions=20).selectExpr(
        "double(id) AS a", "IF(id % 2 = 0, NULL, IF(id % 3 = 0, double('NaN'), id % 10)) AS b", "CAST(NULL AS double) AS c", "id + 1 AS w")
    found = summaries(df, [F.col(c) for c in "abc"], F.col("w"), size=200)
    assert found[0].total == pytest.approx(20_000 * 20_001 / 2) and found[0].rank_error() < 0.06
    assert found[1].value.tolist() == [1, 3, 5, 7, 9] and found[1].rank_error() == 0
    assert len(found[2].value) == 0 and len(found[2].cuts(10)) == 0


def test_small_trees_are_walked_like_large_ones(monkeypatch):
    rng = np.random.default_rng(5)
    for kind, missing in (np.uint8, 9), (np.uint16, 300):
        bins = rng.integers(0, missing + 1, (4, 500)).astype(kind)
        for depth in range(1, 5):
            tree = boosting.Tree.leaf(depth, 0.0)
            for i in range((1 << depth) - 1):
                if (not i or tree.feature[(i - 1) // 2] >= 0) and rng.random() < 0.8:
                    tree.feature[i], tree.bin[i], tree.missing_left[i] = rng.integers(4), rng.integers(missing), rng.random() < 0.5
            monkeypatch.setattr(boosting, "SMALL_TREE", 255)
            small = tree.nodes(bins, missing)
            monkeypatch.setattr(boosting, "SMALL_TREE", 0)
            assert small.tolist() == tree.nodes(bins, missing).tolist()


def test_files_do_not_set_how_many_histograms_are_sent(spark, tmp_path):
    few, many = frame(spark, files=2), frame(spark).repartition(40)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "2k")
    try:
        first, second = blocks_of(few, tmp_path / "few"), blocks_of(many, tmp_path / "many")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert second.parts <= spark.sparkContext.defaultParallelism
    assert second.table.rdd.getNumPartitions() == second.parts
    settings = Settings(n_estimators=1, max_depth=2, colsample_bytree=0.6)
    sent = boosting._level_sums(boosting._shared(first, [_fitting(first, settings)], level=0, number=0, seed=88))
    rows = first.table.mapInArrow(sent, boosting._SUMS).collect()
    # Of three features the tree may split on one, and only its sums travel.
    assert {len(r.sums) for r in rows} == {2 * 8 * (first.missing + 1)}


def _fitting(blocks, settings):
    return boosting._Fitting(
        boosting.Model(settings, blocks.start(-1), blocks.cuts), [], boosting.Tree.leaf(settings.max_depth, 0.0),
        boosting.columns_of(settings, 0, 88, len(blocks.cuts)),
    )

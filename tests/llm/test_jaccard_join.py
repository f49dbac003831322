import random
import re

import numpy as np
import pytest

from arrears.llm import jaccard_join
from arrears.llm.components import components, forest
from arrears.llm.jaccard_join import bands_for, drop_near_duplicates, jaccard_classes, shared_counts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = "doc_id long, text string, class_id int, node int, `a.b` string"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, 1, 2, "c") for i, t in pairs], COLUMNS).repartition(4)


def grams(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(pairs):
    sets = [grams(t) for _, t in pairs]
    n = len(pairs)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and sets[i] and sets[j]:
                linked[i, j] = 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    root = forest(linked)
    out = []
    for i in range(n):
        members = [j for j in range(n) if root[j] == root[i]]
        ids = [pairs[j][0] for j in members if pairs[j][0] is not None]
        out.append((pairs[i][0], min(ids, default=None), len(members), int(linked[i].sum())))
    return sorted(out, key=repr), len(set(root.tolist()))


def check(spark, pairs):
    want, n_classes = expected(pairs)
    found = jaccard_classes(table(spark, pairs)).cache()
    got = [(r.doc_id, r.class_id, r.class_size, r.n_links) for r in found.collect()]
    assert sorted(got, key=repr) == want
    assert found.where("kept").count() == n_classes
    kept = drop_near_duplicates(table(spark, pairs))
    assert kept.columns == ["doc_id", "text", "class_id", "node", "a.b"] and kept.count() == n_classes


def edited(rng, words, share):
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in words)


def corpus(rng, n_groups, size):
    pairs, i = [], 0
    for g in range(n_groups):
        words = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 200]))]
        for _ in range(rng.randrange(1, size)):
            pairs.append((i, edited(rng, words, rng.choice([0, 0, 0.005, 0.02, 0.1]))))
            i += 1
    return pairs


def test_equals_all_pairs(spark):
    check(spark, corpus(random.Random(4), 40, 8))


def test_awkward_rows(spark):
    rng = random.Random(2)
    long = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    pairs = [(1, None), (2, ""), (3, "!!"), (4, "a b c"), (5, "A, b. C"), (6, "a b c d"), (7, "one"), (8, "one one"),
             (9, " ".join(long)), (9, " ".join(long)), (None, " ".join(long)), (10, edited(rng, long, 0.01)),
             (11, "x" * 100_000), (12, "same " * 9000), (13, "same " * 5)]
    check(spark, pairs)


def test_a_group_larger_than_a_block(spark, monkeypatch):
    for name in ("BUCKET_BLOCK", "GROUP_BLOCK"):
        monkeypatch.setattr(jaccard_join, name, 20)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(150)]
    pairs = [(i, edited(rng, words, rng.choice([0.002, 0.01, 0.02]))) for i in range(130)]
    check(spark, pairs + [(i, f"other text number {i} of its own kind") for i in range(130, 150)])


def test_an_empty_table(spark):
    assert jaccard_classes(table(spark, [])).count() == 0
    assert drop_near_duplicates(table(spark, [(1, ""), (2, None)])).count() == 2


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9), (0.9, 0.99)):
        bands, rows = bands_for(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= jaccard_join.MOST_HASHES


@pytest.mark.parametrize("m, values", [(3, 10), (40, 30), (60, 3000)])
def test_shared_counts(m, values):
    rng = np.random.default_rng(m)
    sets = [np.unique(rng.integers(0, values, rng.integers(1, 200)).astype(np.uint64)) for _ in range(m)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert shared_counts(sets).tolist() == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)]
    linked = np.zeros((300, 300), bool)
    for u, v in edges:
        linked[u, v] = linked[v, u] = u != v
    root = forest(linked)
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    nodes = {u for e in edges if e[0] != e[1] for u in e}
    assert {r.node: r.component for r in got} == {n: root[n] for n in nodes}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0

import random
import re

import numpy as np
import pytest

from arrears.llm.decontaminate import _winnow, contamination, drop_contaminated, is_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def expected(docs, items):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            n = min(13, len(w))
            passages = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
            for p in range(len(own) - n + 1) if w else ():
                if tuple(own[p : p + n]) in passages:
                    hit.update(range(p, p + n))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((doc_id, len(own), len(hit), sorted(found), sum(b - a for a, b in _runs(hit))))
    return sorted(out, key=repr)


def _runs(hit):
    return [(p, p + 1) for p in hit]


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, `a.b` string")
    return d.repartition(4), spark.createDataFrame(items, "item_id long, text string")


def check(spark, docs, items):
    d, i = tables(spark, docs, items)
    found = contamination(d, i).cache()
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), sum(s.end - s.begin for s in r.spans)) for r in found.collect()]
    want = expected(docs, items)
    assert sorted(got, key=repr) == want
    clean = drop_contaminated(d, i)
    assert clean.columns == d.columns
    keep = sorted(repr(w[0]) for w in want if not (w[2] and 20 * w[2] >= w[1]))
    assert sorted(repr(r.doc_id) for r in clean.collect()) == keep
    return found


def test_planted_passages(spark):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([5, 12, 13, 14, 40]))) for i in range(25)] + [(3, text(20)), (None, text(15)), (70, None)]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(w) or 1)
            parts += [" ".join(w[a : a + rng.randrange(1, 40)]), text(rng.randrange(10))]
        docs.append((i, " ".join(parts).title() if i % 3 else ", ".join(parts)))
    found = check(spark, docs, items)
    assert found.where(is_contaminated()).count() > 5


def test_items_of_every_length_are_found_everywhere(spark):
    rng = random.Random(5)
    items = [(n, " ".join(f"i{n}x{j}" for j in range(n))) for n in range(1, 15)]
    docs = []
    for i in range(280):
        fill = [f"f{rng.randrange(10_000)}" for _ in range(30)]
        at = rng.randrange(31)
        docs.append((i, " ".join([*fill[:at], items[i % 14][1], *fill[at:]])))
    check(spark, docs, items)


def test_awkward_rows(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, None), (2, ""), (3, "!!"), (4, item), (5, item), (5, item), (None, item), (6, "same " * 5000),
            (7, "x" * 100_000 + " " + item), (8, "É é " + item), (9, "w1"), (10, " ".join(item.split()[:12]))]
    items = [(1, item), (2, "same " * 14), (3, ""), (4, None), (5, "É"), (6, item), (6, item)]
    check(spark, docs, items)


def test_empty_tables(spark):
    d, i = tables(spark, [], [(1, "a b c")])
    assert contamination(d, i).count() == 0
    d, i = tables(spark, [(1, "a b c")], [])
    assert contamination(d, i).first().n_hit == 0 and drop_contaminated(d, i).count() == 1


def test_a_small_bit_array_changes_nothing(spark):
    docs = [(i, " ".join(f"w{(i * j) % 90}" for j in range(200))) for i in range(60)]
    items = [(i, " ".join(f"w{(i * j) % 90}" for j in range(3, 33))) for i in range(30)]
    d, i = tables(spark, docs, items)
    large, small = contamination(d, i), contamination(d, i, filter_bits=6)
    assert large.drop("key").exceptAll(small.drop("key")).count() == 0


@pytest.mark.parametrize("n", [0, 3, 7, 50])
def test_every_window_has_a_fingerprint(n):
    hashes = np.random.default_rng(n).integers(0, 9, n).astype(np.uint64)
    kept = _winnow(hashes, 7)
    for i in range(n - 6):
        assert (kept[i : i + 7] & (hashes[i : i + 7] == hashes[i : i + 7].min())).any()


def test_columns_with_names_of_its_own(spark):
    text = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text, 5, 6), (2, "something else", 7, 8)], "doc_id long, text string, bad_key int, row int")
    items = spark.createDataFrame([("a", text)], "item_id string, text string")
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "something else", 7, 8)]

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from arrears.llm import exact_dedup
from arrears.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

COLUMNS = "doc_id long, text string, keep_id int, norm string, `a.b` string"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "n", "c") for i, t in pairs], COLUMNS).repartition(5)


def expected(pairs):
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(pairs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, place))
    out = []
    for members in groups.values():
        best = min(members)
        out += [(pairs[m[3]][0], pairs[best[3]][0], len(members), m[3] == best[3]) for m in members]
    return sorted(out, key=repr)


def check(spark, pairs):
    got = exact_duplicates(table(spark, pairs)).drop("text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == expected(pairs)
    kept = drop_exact_duplicates(table(spark, pairs))
    assert kept.columns == ["doc_id", "text", "keep_id", "norm", "a.b"]
    want = sorted(repr(e[0]) for e in expected(pairs) if e[3])
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_awkward_rows(spark):
    pairs = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a  b"), (6, "a  b"), (None, "a  b"),
             (7, "é é"), (8, "éé"), (9, "x" * 400_000), (10, "x " * 400_000), (11, "a b"), (12, "A b")]
    check(spark, pairs)


def test_a_text_of_a_third_of_the_rows_is_sorted_in_slices(spark):
    rng = random.Random(1)
    pairs = [(i, " " * rng.randrange(4) + "hot text") for i in range(700)] + [(i, f"t{i // 2}") for i in range(700, 2000)]
    check(spark, pairs)


def test_texts_that_begin_alike_are_told_apart(spark):
    check(spark, [(i, "same beginning " * 20 + str(i % 50)) for i in range(200)])


def test_an_empty_table(spark):
    assert exact_duplicates(table(spark, [])).count() == 0
    assert drop_exact_duplicates(table(spark, [])).count() == 0


def test_plan_is_native_and_sorts_by_content(spark):
    plan = exact_duplicates(table(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning(head" in plan
    # The window takes the range partitioning as it is.
    assert "hashpartitioning(head" not in plan and "hashpartitioning(norm" not in plan


def test_hash_is_of_the_normalised_text(spark):
    row = exact_duplicates(table(spark, [(1, " a\tb ")])).first()
    assert row.text_sha256 == spark.range(1).select(F.sha2(F.lit("ab"), 256)).first()[0]
    assert exact_dedup.SPACES == "".join(chr(c) for c in (32, 9, 10, 11, 12, 13))

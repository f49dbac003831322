import random
import re
from collections import Counter
from itertools import permutations

from awkward import AWKWARD
from pyspark.sql import functions as F

from arrears.llm import interaction
from arrears.llm.interaction import interactions, mask, mask_counts

DOCS = "doc_id long, text string, lang string, mask int, `a.b` int"
LABELS = "doc_id long, quality int, toxic int, mask int"


def mask_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        (len(words) < 100) + 2 * (100 * len(set(words)) < 80 * len(words))
        + 4 * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))
    )


def expected_counts(docs, labels):
    flags = {}
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            flags[doc_id] = flags.get(doc_id, 0) | (quality == 1) | 2 * (toxic == 1)
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    return Counter(
        (lang or "", flags.get(doc_id, 0), mask_of(text) + 16 * (doc_id is not None and least[text or ""] < doc_id))
        for doc_id, text, lang in docs
    )


def expected_report(counts):
    rows = []
    for part in {k[0] for k in counts}:
        own = [(label, {f for i, f in enumerate("ABCDE") if mask >> i & 1}, n) for (p, label, mask), n in counts.items() if p == part]
        lost = {f: 0 for f in "ABCDE"}
        table = {}
        for order in permutations("ABCDE"):
            for label, fails, n in own:
                first = next((f for f in order if f in fails), None)
                if first:
                    lost[first] += n
        for order in permutations("ABCDE"):
            for i, f in enumerate(order):
                before = set(order[:i])
                count = lambda keep: sum(n for label, fails, n in own if keep(label, fails))  # noqa: E731, B023
                here = lambda fails: f in fails and not fails & before  # noqa: E731, B023
                table["".join(order), i + 1] = (
                    count(lambda label, fails: not fails & (before | {f})),
                    count(lambda label, fails: here(fails)),
                    count(lambda label, fails: f in fails and fails & before),
                    count(lambda label, fails: fails == {f}),
                    count(lambda label, fails: here(fails) and label & 1),
                    count(lambda label, fails: here(fails) and label & 2),
                    lost[f],
                )
        rows += [(part, *k, *v) for k, v in table.items()]
    return sorted(rows)


def write(spark, docs, path, files=4, mode="overwrite"):
    frame = spark.createDataFrame([(i, t, lang, 1, 2) for i, t, lang in docs], DOCS).repartition(files)
    frame.write.mode(mode).parquet(str(path))


def counts_of(spark, path, labels, **options):
    frame = spark.createDataFrame([(*x, 1) for x in labels], LABELS)
    return {(r.part, r.label, r.mask): r.n for r in mask_counts(spark, str(path), frame, **options).collect()}


def random_docs(seed, n):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(["one", "Two", "THREE", "$", "four|", "five"] + [f"w{i}" for i in range(w)], k=k))
             for w in (0, 50, 400) for k in (0, 5, 99, 100, 101, 150)]
    ids = [*range(n), None, None, *[rng.randrange(n) for _ in range(20)]]
    rng.shuffle(ids)
    return [(i, texts[0] if rng.random() < 0.3 else rng.choice(texts), rng.choice(["en", "de", "", None])) for i in ids]


def test_masks_of_random_and_awkward_texts(spark):
    texts = [t for _, t in AWKWARD] + [t for _, t, _ in random_docs(1, 200)] + ["A" * 10 + "b" * 90, "A" * 11 + "b" * 89, "Ä" * 5 + "É"]
    table = spark.createDataFrame(list(enumerate(t or "" for t in texts)), "i int, text string")
    got = {r.i: r.mask for r in table.select("i", mask(F.col("text")).alias("mask")).collect()}
    assert [got[i] for i in range(len(texts))] == [mask_of(t) for t in texts]


def test_counters_after_many_batches_with_smaller_ids_arriving_late(spark, tmp_path, monkeypatch):
    docs = random_docs(2, 300)
    labels = [(i, i % 3, i % 5) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    write(spark, docs, tmp_path / "docs", 9)
    monkeypatch.setattr(interaction, "MOST_TEXTS", 3)
    monkeypatch.setattr(interaction, "TEXTS_PER_STATE", 4)
    folder = str(tmp_path / "work")
    got = counts_of(spark, tmp_path / "docs", labels, batches=9, folder=folder)
    assert got == expected_counts(docs, labels)
    assert spark.read.parquet(f"{folder}/changes").select("batch").distinct().count() == 9


def test_files_that_come_later_change_the_counters_without_reading_the_old_ones(spark, tmp_path):
    old = [(100 + i, f"text number {i % 20}", "en") for i in range(60)]
    new = [(i, f"text number {i % 30}", "de") for i in range(40)]
    folder = str(tmp_path / "work")
    write(spark, old, tmp_path / "docs")
    assert counts_of(spark, tmp_path / "docs", [], folder=folder) == expected_counts(old, [])
    write(spark, new, tmp_path / "docs", mode="append")
    assert counts_of(spark, tmp_path / "docs", [], folder=folder) == expected_counts(old + new, [])
    retracted = spark.read.parquet(f"{folder}/changes").where("n < 0").groupBy().sum("n").first()[0]
    assert retracted == -20


def test_awkward_rows(spark, tmp_path):
    docs = [(i, t, "en") for i, t in AWKWARD] + [(None, None, None), (3, "", None)]
    write(spark, docs, tmp_path / "docs")
    counts = mask_counts(spark, str(tmp_path / "docs"), spark.createDataFrame([(4, 1, 1, 0)], LABELS))
    assert {(r.part, r.label, r.mask): r.n for r in counts.collect()} == expected_counts(docs, [(4, 1, 1)])
    assert sorted(map(tuple, interactions(counts).collect())) == expected_report(expected_counts(docs, [(4, 1, 1)]))


def test_an_empty_table(spark, tmp_path):
    write(spark, [], tmp_path / "docs")
    assert interactions(mask_counts(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABELS))).collect() == []


def test_a_single_file(spark, tmp_path):
    write(spark, [(2, "same", "en"), (1, "same", "en")], tmp_path / "docs", 1)
    file = next((tmp_path / "docs").glob("part-*.parquet"))
    assert counts_of(spark, file, []) == {("en", 0, 1): 1, ("en", 0, 17): 1}

"""Registered queries against their SQL, and the pipeline against a plain version."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from arrears.llm import quality
from arrears.llm.components import forest
from arrears.llm.oracle import ORACLE
from arrears.llm.queries import QUERIES
from test_decontaminate import expected as hits_of
from test_jaccard_join import grams


def plain(rows):
    return sorted((tuple(str(v) for v in row) for row in rows))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert plain(got.select(*names).collect()) == plain(want.fetchall())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) and "pipeline" not in driver.oracle_sql()
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in QUERIES) if m)
    assert numbers == list(range(1, 14))


def test_pipeline_equals_a_plain_version(spark, sf_dir):
    """Every stage in Python over the documents; the classifier's weights are its own, its decisions are checked elsewhere."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, docs, sf_dir)
    assert good.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    assert 0.5 * docs.count() < len(rows) < docs.count()

    best = {}
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text)
        best[key] = min(best.get(key, (0, doc_id)), (-len(text), doc_id)) if key in best else (-len(text), doc_id)
    stay = {doc_id for _, doc_id in best.values()}
    rows = [r for r in rows if r[0] in stay]

    sets = [grams(t) for _, t in rows]
    linked = np.array([[bool(a and b) and 5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets])
    root = forest(linked)
    rows = [r for i, r in enumerate(rows) if root[i] == i]

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {h[0] for h in hits_of(rows, items) if h[2] and 20 * h[2] >= h[1]}
    rows = [r for r in rows if r[0] not in bad]

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == want
    assert sum(p.length for p in pieces) == sum(want.values())


def test_stages_return_the_columns_of_their_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(0).unionByName(spark.createDataFrame(
        [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (None, "", None, None, None), (2, "a b c", "en", "s", 5)], docs.schema))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (odd, docs.limit(0)):
            out = stage(spark, given, sf_dir)
            assert out.columns == docs.columns, name
            assert out.count() <= given.count()
    assert corpus_pipeline.packed(spark, docs.limit(0), sf_dir).count() == 0


def test_quality_threshold_is_that_of_the_query():
    assert quality.THRESHOLD == 0.3

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from awkward import AWKWARD, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from arrears.llm import packing, queries
from arrears.llm.packing import WordTokenizer, pack, place_lengths

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
OWN = WordTokenizer(open(PATH, encoding="utf-8").read())


def ids_of(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abXYZ'strelvmd0129.,! \t\n\x0b\x1c\x85éÈßÿ×÷Ü«¡µº½őİß́🙂<|>"), max_size=40), max_size=5))
def test_ids_are_those_of_the_tokenizer(texts):
    got = OWN.encode(pa.array(texts, pa.string()))
    assert [a.tolist() for a in got] == [ids_of(t)[:-1] for t in texts]


def test_a_full_store_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "MOST_WORDS", 50)
    own = WordTokenizer(open(PATH, encoding="utf-8").read())
    for a in range(0, 300, 20):
        texts = [" ".join(f"{chr(97 + (a + i) // 26 % 26)}{chr(97 + (a + i) % 26)}x" for i in range(20)), "ab cd"]
        assert [x.tolist() for x in own.encode(pa.array(texts))] == [ids_of(t)[:-1] for t in texts]
    many = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    assert own.encode(pa.array([many]))[0].tolist() == ids_of(many)[:-1]


def check(rows, docs, length=4096):
    texts = defaultdict(Counter)
    for doc_id, text in docs:
        texts[doc_id][tuple(ids_of(text))] += 1
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.length == len(ids) and zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id, r.doc_tokens, r.start].append(tuple(ids.tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, counted in texts.items():
        for ids, times in counted.items():
            for a in range(0, len(ids), length):
                assert pieces[doc_id, len(ids), a].count(ids[a : a + length]) >= times
    assert sum(r.length for r in rows) == sum(len(ids) * n for c in texts.values() for ids, n in c.items())
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    assert sorted(sequences) == list(range(len(sequences)))


def test_awkward_rows(spark):
    check(pack(frame(spark, AWKWARD), PATH).collect(), AWKWARD)


def test_short_sequences_over_many_partitions(spark):
    rng = random.Random(3)
    docs = [(i, "word " * rng.choice([0, 1, 3, 9, 30, 31, 200])) for i in range(300)]
    check(pack(frame(spark, docs, 7), PATH, length=32).collect(), docs, 32)


def test_an_empty_table(spark):
    assert pack(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_places_hold_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 65): rng.randrange(1, 40) for _ in range(rng.randrange(1, 40))}
    used = Counter()
    for size, n in histogram.items():
        ranks = []
        for own, rank, count, first, offset in place_lengths(histogram, 64):
            if own == size:
                ranks += range(rank, rank + count)
                for s in range(first, first + count):
                    used[s] += size
                    assert offset + size <= 64
        assert ranks == list(range(n))
    assert max(used.values()) <= 64 and sorted(used) == list(range(len(used)))


def test_a_length_goes_to_the_pattern_with_the_most_room():
    assert place_lengths({3000: 1, 2500: 1, 1000: 1}) == [(3000, 0, 1, 0, 0), (2500, 0, 1, 1, 0), (1000, 0, 1, 1, 2500)]
    # Where even that one is too full, new sequences begin.
    assert place_lengths({40: 2, 30: 3}, 64) == [(40, 0, 2, 0, 0), (30, 0, 3, 2, 0)]


def test_places_do_not_grow_with_the_documents():
    few = {n: 3 + n % 7 for n in range(1, 4097)}
    many = {n: c * 100_000 for n, c in few.items()}
    assert len(place_lengths(many)) <= 1.1 * len(place_lengths(few))
    total = sum(n * c for n, c in many.items())
    sequences = max(first + count for _, _, count, first, _ in place_lengths(many))
    assert total / (sequences * 4096) > 0.99


def test_query_packs_every_document(spark, sf_dir):
    rows = queries.op4_packing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(d.text)) for d in docs)
    assert "ids" not in rows[0].asDict()


def reversed_ids(ids):
    """The ids of a piece in the opposite order: four bytes each."""
    starts = F.sequence(F.length(ids) - 3, F.lit(1), F.lit(-4))
    return F.unhex(F.array_join(F.transform(starts, lambda i: F.hex(F.substring(ids, i, F.lit(4)))), ""))


def test_query_takes_its_digests_from_the_packed_ids(spark, sf_dir, monkeypatch):
    whole = packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **b: whole(*a, **b).withColumn("ids", reversed_ids(F.col("ids"))))
    want = Counter()
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = ids_of(d.text)
        for a in range(0, len(ids), 4096):
            want[d.doc_id, a, zlib.crc32(np.array(ids[a : a + 4096][::-1], "<u4").tobytes())] += 1
    rows = queries.op4_packing(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in rows) == want


def test_pipeline_returns_the_ids(spark):
    docs = frame(spark, AWKWARD)
    check(corpus_pipeline.packed(spark, docs, "").collect(), AWKWARD)

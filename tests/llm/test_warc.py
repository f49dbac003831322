import gzip
import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from arrears.llm.warc import LoserTree, capture_index, id_of, parse, read_archives, url_key, write_archives
from pyspark.sql import functions as F

BIG = "<p>same</p>" * 200
PAGES = [
    (1, "http://a.com/", BIG), (2, "http://b.com/x?y#z", BIG), (3, "http://b.com/x?y", "small"), (4, None, "small"),
    (5, "http://a.com/", None), (6, "http://c.com/\r\nWARC-Type: x", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (7, "é", "é" * 600),
    (8, "é", "é" * 600), (8, "é", "é" * 600), (None, "http://n.com", BIG), (9, "u", "x" * 300_000), (10, "u", "a\x00\x0b" * 400), (11, "", ""),
]


def expected(pages):
    best = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            best[data] = max(i, best.get(data, i))
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        first = best.get(data) if len(data) >= 1000 else None
        times = sum((h or "").encode() == data for _, _, h in pages)
        again = first is not None and i != first and times > 1
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def table(spark, pages):
    rows = [(i, u, h, "t", 0) for i, u, h in pages]
    return spark.createDataFrame(rows, "page_id long, url string, html string, time string, `a.b` int").repartition(3)


def test_pages_come_back(spark, tmp_path):
    path = str(tmp_path / "w")
    write_archives(table(spark, PAGES), path)
    index = capture_index(spark, path).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.to) for r in spark.createDataFrame(index).select(
        id_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        id_of(F.col("refers_to")).alias("to")).collect()]
    assert sorted(got, key=repr) == expected(PAGES)
    payloads = sorted(bytes(r.payload) for r in read_archives(spark, path).where("payload IS NOT NULL").collect())
    want = [(h or "").encode() for i, _, h in PAGES if (i, "response") in {(g[0], g[3]) for g in got}]
    assert payloads == sorted(want)


def test_archives_are_plain_gzip_and_runs_are_sorted(spark, tmp_path):
    path = tmp_path / "w"
    write_archives(table(spark, PAGES), str(path))
    n = 0
    for file in path.glob("*.gz"):
        n += sum(1 for _ in parse(gzip.decompress(file.read_bytes())))
    assert n == len(PAGES)
    runs = {}
    for r in read_archives(spark, str(path), payloads=False).collect():
        runs.setdefault(r.archive, []).append((r.url_key, r.time, r.record_id))
    assert all(run == sorted(run) for run in runs.values())


def test_the_index_is_in_global_order(spark, tmp_path):
    rng = random.Random(1)
    pages = [(i, f"http://{rng.choice('abc')}.com/{rng.randrange(5)}" if i % 3 else "http://hot.com/", f"p{i}") for i in range(600)]
    write_archives(table(spark, pages).repartition(9), str(tmp_path / "w"))
    rows = capture_index(spark, str(tmp_path / "w")).orderBy("range", "place").collect()
    keys = [(r.url_key, r.time, r.record_id) for r in rows]
    assert len(rows) == 600 and keys == sorted(keys)


def test_no_pages(spark, tmp_path):
    write_archives(table(spark, []), str(tmp_path / "w"))
    assert capture_index(spark, str(tmp_path / "w")).count() == 0


@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree_merges(runs):
    merged = list(LoserTree([iter(sorted(r)) for r in runs]))
    assert [head for _, head in merged] == sorted(x for r in runs for x in r)
    # Equal heads come in the order of their runs.
    assert merged == sorted(merged, key=lambda m: (m[1], m[0]))


def test_a_broken_archive_is_refused():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [block for _, _, block in parse(good * 2)] == [b"ab", b"ab"]
    for bad in (good.replace(b": 2", b": 1"), b"x" + good, good[:-2]):
        with pytest.raises(ValueError):
            list(parse(bad))


def test_url_keys():
    assert url_key("https://www.Example.com/A?b#c") == "com,example)/a?b" and url_key("") == ")"

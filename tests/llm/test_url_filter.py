import pytest

from arrears.llm import queries, url_filter
from arrears.llm.url_filter import LABELLED, judged, parts_of, train

URLS = [
    (1, "HTTPS://WWW.Example.NET/en/1?x=/fr/"), (2, "http://a.net"), (3, "http://a.net/"), (4, "http://net/x"),
    (5, "http://xnet/"), (6, "https://Example.com/de/a#b"), (7, "https://sub.example.com/DE/"), (8, "http://x.org/fr/"),
    (9, "http://x.org/fr"), (10, None), (11, ""), (12, "no scheme"), (13, "://"), (14, "a://b://c/d"), (15, "http://h?q/p"),
    (16, "http://h#f/p"), (17, "http://ÄÖ.net/é"), (18, "http://example.net:80/en/"), (19, "x" * 50_000), (20, "http://" + "h" * 50_000),
    (20, "http://casino-win.example.com/slots"), (21, "http://a\nb.net/\nx"), (None, "http://casino-win.example.com/slots"),
]


def rule(host, path):
    best = None
    for text, verdict in url_filter.RULES:
        h, p = text[: text.index("/")], text[text.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


def table(spark, rows):
    return spark.createDataFrame([(i, u, "x", 1, 2) for i, u in rows], "page_id long, url string, host string, chance int, `a.b` int")


def test_parts_rules_and_verdicts(spark):
    model = train(LABELLED)
    rows = judged(table(spark, URLS)).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = parts_of(r.page.url)
        assert (r.host, r.path) == (host, path)
        best = rule(host, path)
        assert r.rule == (best[0] if best else None)
        assert r.verdict == (best[1] if best else "block" if r.chance >= 0.5 else "allow")
    import pyarrow as pa

    hosts, paths = pa.array([r.host for r in rows]), pa.array([r.path for r in rows])
    assert model.chance(hosts, paths).tolist() == pytest.approx([r.chance for r in rows])


def test_empty_table(spark):
    assert judged(table(spark, [])).count() == 0


def test_the_model_learns_its_table_and_hosts_like_them():
    import pyarrow as pa

    model = train(LABELLED)
    chance = lambda url: model.chance(*(pa.array([x]) for x in parts_of(url)))[0]
    assert all((chance(url) >= 0.5) == bool(label) for url, label in LABELLED)
    held = []
    for i in range(0, len(LABELLED), 6):
        rest = [row for j, row in enumerate(LABELLED) if j != i]
        host, path = parts_of(LABELLED[i][0])
        held.append((train(rest).chance(pa.array([host]), pa.array([path]))[0] >= 0.5) == bool(LABELLED[i][1]))
    assert sum(held) >= 0.75 * len(held)
    assert chance("http://www.casino-win.example.org/en/3") > 0.5 > chance("http://www.harbour.example.org/en/3")


def test_query_covers_all_pages(spark, sf_dir):
    rows = queries.op3_url_filter(spark, sf_dir).collect()
    pages = {p.page_id: p.url for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.host, r.path) == parts_of(pages[r.page_id])
        best = rule(r.host, r.path)
        assert r.rule == (best and best[0]) and (not best or r.verdict == best[1])

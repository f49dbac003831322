import hashlib
import re
import time
import uuid

import pytest
from awkward import AWKWARD, frame
from pyspark.sql import functions as F

from arrears.llm import queries, secrets
from arrears.llm.secrets import BASE, RULES, Rule, scan_versions, scanner, version_of

KEY = "AKIA" + "Z9" * 9
TEXTS = [
    f'Token = "{"a1" * 12}" and {KEY}', "password: abc passwd:abcdef", "API_KEY='x=/+.-_1' secret=short",
    "password: token: abcdef", "token=token=abcdef", "AKIA123 AKIAAKIA" + "B" * 14, "f" * 23 + " " + "0" * 24,
    "é🙂 secret = abcdef123", "toKen : \"abcdef", "ſecret=abcdef", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36,
    "https://me:pw@host/x", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "apikey:abcdefg,api_key:abcdefg", "password=" + " " * 50_000,
]


def plain(text):
    patterns = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"),
    ]
    found = []
    for order, (kind, pattern) in enumerate(patterns):
        for m in re.finditer(pattern, text or "", re.I | re.A if kind == "assign" else 0):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(found)]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert scanner(BASE)(text) == plain(text)
    kinds = {r.kind for r in BASE}
    assert [s for s in scanner(RULES)(text) if s[0] in kinds] == plain(text)


def test_added_kinds():
    found = {s[0] for t in TEXTS for s in scanner(RULES)(t)}
    assert {"private_key", "code_host", "url_login", "signed"} <= found


def ledger_of(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_awkward_rows_and_copies(spark, tmp_path):
    pairs = AWKWARD + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, TEXTS[0]) for i in range(40)]
    path = ledger_of(tmp_path)
    found = scan_versions(frame(spark, pairs), path).collect()
    got = sorted(((r.version.doc_id, [tuple(s) for s in r.spans if s.kind in ("assign", "access", "hex")]) for r in found), key=repr)
    assert got == sorted(((i, plain(t)) for i, t in pairs), key=repr)
    assert found[0].version.asDict().keys() == {"doc_id", "score", "part", "a.b"}
    assert spark.read.parquet(path).count() == len({t or "" for _, t in pairs})


def scanned_pairs(spark, path):
    """(blob, rule version) of every scan in the ledger."""
    rows = spark.read.parquet(path).select("blob", "ruleset").collect()
    return sorted((bytes(r.blob), v) for r in rows for v in r.ruleset.split("-"))


def test_only_unseen_pairs_of_blob_and_rule_version_are_scanned(spark, tmp_path):
    x, y, z = Rule("x", "xx+"), Rule("y", "yy+"), Rule("z", "zz+")
    path, texts = ledger_of(tmp_path), ["xx yy", "zz", "", "xxx zzz yyy"]
    blobs = {t: hashlib.sha256(t.encode()).digest() for t in [*texts, "a new xxx"]}
    first = frame(spark, [(i, t) for i, t in enumerate(texts)])

    def run(docs, *rules):
        return {r.version.doc_id: [tuple(s) for s in r.spans] for r in scan_versions(docs, path, rules=rules).collect()}

    run(first, x, y)
    pairs = sorted((blobs[t], version_of(r)) for t in texts for r in (x, y))
    assert scanned_pairs(spark, path) == pairs
    # A new blob meets all rules, a new rule all blobs, and nothing is repeated.
    both = first.union(frame(spark, [(99, "a new xxx"), (98, "zz")]))
    got = run(both, x, y, z)
    pairs = sorted(pairs + [(blobs[t], version_of(z)) for t in texts] + [(blobs["a new xxx"], version_of(r)) for r in (x, y, z)])
    assert scanned_pairs(spark, path) == pairs
    assert got == {0: [("x", 0, 2), ("y", 3, 5)], 1: [("z", 0, 2)], 98: [("z", 0, 2)], 2: [],
                   3: [("x", 0, 3), ("z", 4, 7), ("y", 8, 11)], 99: [("x", 6, 9)]}
    # A changed rule is a new version: old spans of its kind no longer count, other rules stand.
    assert run(first, Rule("x", "xxx+"), y)[0] == [("y", 3, 5)]
    assert len(scanned_pairs(spark, path)) == len(pairs) + len(texts)
    assert run(first, x, y)[0] == [("x", 0, 2), ("y", 3, 5)] and run(first, z)[0] == []
    assert len(scanned_pairs(spark, path)) == len(pairs) + len(texts)


def test_partitions_without_a_wanted_rule_are_not_read(spark, tmp_path):
    path, docs = ledger_of(tmp_path), frame(spark, [(1, "xx yy")])
    for rule in (Rule("x", "xx+"), Rule("y", "yy+")):
        scan_versions(docs, path, rules=(rule,))
    known = secrets._known(spark, path, (Rule("y", "yy+"),))
    assert len(known.select(F.input_file_name()).distinct().collect()) == 1
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*Contains\(ruleset", plan)


@pytest.mark.parametrize("part", [
    "eyJ", "eyJabcdefgh.", "eyJ-", "a://b:", "ab://", "x:y@", "a+", "gho_", "xoxb-", "AKIA", "password ", "token=", "-----BEGIN ", "AIza", "f", "A.",
])
def test_very_long_texts_take_linear_time(part):
    begin = time.perf_counter()
    scanner(RULES)(part * (1_000_000 // len(part)))
    assert time.perf_counter() - begin < 5


def test_long_credentials_and_either_case():
    url = f"HTTPS://me:{'p' * 5_000}@host/x"
    assert ("url_login", 4, 4 + url.index("@") + 1) in scanner(RULES)("see " + url)


def test_an_empty_table(spark, tmp_path):
    assert scan_versions(frame(spark, []), ledger_of(tmp_path)).count() == 0


def test_query_equals_the_plain_scan(spark, sf_dir):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op7_secrets(spark, sf_dir).collect():
        spans = plain(docs[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))

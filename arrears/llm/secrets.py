"""Secrets in every version of every file, by an incremental blob ledger.

A version's text is named by its SHA-256: the blob. Every rule has a version of
its own, which changes with its pattern. The ledger tells which blobs have been
scanned under which rule versions, and the spans found: a row has a blob and the
spans of the rules of its ``ruleset``, the versions that were new to the blob when
it was scanned. It is partitioned by ``ruleset``, so a run reads only the parts
that know a rule of its own.

A run scans each blob under those rules that the ledger does not have for it, once
whatever the number of its paths, appends what it found, and joins the ledger back
to all paths. A new rule is looked for in all blobs, the old ones are not repeated;
spans of versions that are no longer in use are left aside. A row is written only
when its blob has been scanned whole, so a run that dies leaves nothing half done:
its blobs are scanned again.

Copies are merged before the shuffle. Spans are in code points, end exclusive,
by start, then in the order of the rules; matches of one rule do not overlap.
Null texts count as empty. Rows equal in all columns are separate rows of the
result. An empty table appends nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm.tables import column, ship, text_column, written
from arrears.llm.words import slices


@dataclass(frozen=True)
class Rule:
    """``pattern``, and how long the match, or its group ``group``, must be; ``hint``: texts without any of these have no match."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    hint: tuple[str, ...] = ()
    flags: int = 0


# The base rules.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6, 2, (":", "="), re.IGNORECASE | re.ASCII,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 20, 0, ("AKIA",)),
    Rule("hex", "[0-9a-f]+", 24),
)
#: What the base rules miss: keys by their public prefixes, key blocks, signed tokens, credentials in URLs.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint=("PRIVATE KEY-----",)),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}", hint=("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint=("xox",)),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}", hint=("AIza",)),
    # A match begins where a run of its characters does: inside one it would be tried at every place.
    Rule("signed", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", hint=("eyJ",)),
    Rule("url_login", r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,15}+://[^\s/:@]++:[^\s/:@]++@", hint=("://",)),
)
RULES = BASE + ADDED

_FOUND = "blob binary, spans array<struct<kind:string,start:long,end:long>>, ruleset string"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def version_of(rule: Rule) -> str:
    """A name that changes with the rule."""
    return hashlib.sha256(repr(rule).encode()).hexdigest()[:12]


def ruleset_of(rules: Iterable[Rule]) -> str:
    """The versions of some rules, as the ledger names its partitions."""
    return "-".join(sorted(map(version_of, rules)))


def scanner(rules: tuple[Rule, ...] = RULES) -> Callable[[str], list[tuple[str, int, int]]]:
    """Function from a text to its spans."""
    ready = []
    for rule in rules:
        # Runs of one character class that are too short need not be looked at one by one.
        pattern = f"{rule.pattern[:-1]}{{{rule.least},}}" if rule.pattern == "[0-9a-f]+" else rule.pattern
        ready.append((rule, re.compile(pattern, rule.flags)))

    def spans(text: str) -> list[tuple[str, int, int]]:
        found = []
        for order, (rule, pattern) in enumerate(ready):
            if rule.hint and not any(h in text for h in rule.hint):
                continue
            for m in pattern.finditer(text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found.append((m.start(), order, rule.kind, m.end()))
        return [(kind, start, end) for start, _, kind, end in sorted(found)]

    return spans


def _scanned(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Spans of blob and text by the rules that ``missing`` names by their kinds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[tuple[str, ...], tuple] = {}
        for batch in batches:
            for part in slices(batch, 1):
                found, sets = [], []
                for text, kinds in zip(part.column(1).to_pylist(), map(tuple, part.column(2).to_pylist()), strict=True):
                    if kinds not in ready:
                        own = tuple(r for r in rules if r.kind in kinds)
                        ready[kinds] = scanner(own), ruleset_of(own)
                    spans, ruleset = ready[kinds]
                    found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans(text)])
                    sets.append(ruleset)
                yield pa.record_batch([part.column(0), pa.array(found, _SPANS), pa.array(sets, pa.string())], names=["blob", "spans", "ruleset"])

    return blobs.select("blob", "text", "missing").mapInArrow(scan, _FOUND)


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; an empty one is made where none is."""
    spark.createDataFrame([], _FOUND).write.mode("append").partitionBy("ruleset").parquet(path)
    return spark.read.schema(_FOUND).parquet(path)


def _known(spark: SparkSession, path: str, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows of the ledger that know a rule of ``rules``; other partitions are not read."""
    knows = [F.col("ruleset").contains(version_of(r)) for r in rules]
    return open_ledger(spark, path).where(reduce(Column.__or__, knows, F.lit(False)))


def scan_versions(versions: DataFrame, ledger: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` without its text, as a struct ``version``, with ``blob`` and ``spans``; the ledger grows by what was unseen."""
    spark = versions.sparkSession
    ship(spark)
    text = text_column(versions, text_col)
    blob = F.unhex(F.sha2(text, 256))
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    has = {r.kind: F.col("ruleset").contains(version_of(r)) for r in rules}
    seen = _known(spark, ledger, rules).groupBy("blob").agg(
        F.array_compact(F.array(*(F.when(F.bool_or(known), F.lit(kind)) for kind, known in has.items()))).alias("scanned")
    )
    unseen = (
        versions.select(blob.alias("blob"), text.alias("text"))
        .groupBy("blob").agg(F.first("text").alias("text"))
        .join(seen, "blob", "left")
        .withColumn("missing", F.array_except(kinds, F.coalesce("scanned", F.array().cast("array<string>"))))
        .where(F.size("missing") > 0)
    )
    _scanned(unseen, rules).write.mode("append").partitionBy("ruleset").parquet(ledger)
    # Of a row's spans those count whose rule has the version that the row was scanned under.
    current = reduce(Column.__or__, ((F.col("span.kind") == kind) & known for kind, known in has.items()), F.lit(False))
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i))) if rules else F.lit(None)
    spans = _known(spark, ledger, rules).select("blob", "ruleset", F.explode_outer("spans").alias("span")).select(
        "blob", F.when(current, F.struct(
            F.col("span.start").alias("start"), order[F.col("span.kind")].alias("rule"), F.col("span.kind").alias("kind"), F.col("span.end").alias("end")
        )).alias("span"),
    )
    found = spans.groupBy("blob").agg(F.array_sort(F.collect_set("span")).alias("spans")).select(
        "blob", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans")
    )
    kept = [column(versions, c) for c in versions.columns if c != text_col]
    paths = written(versions.select(F.struct(*kept).alias("version"), blob.alias("blob")), "paths")
    return paths.join(found, "blob").select("version", "blob", "spans")

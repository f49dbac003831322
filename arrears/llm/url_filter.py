"""URL verdicts: host and path rules first, then logistic regression on hashed character n-grams.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A null url or one
without ``://`` has neither. A rule fits its host and all subdomains when the
path begins with the rule's; the longest rule wins. What no rule fits gets the
model's verdict: it is trained on a small labelled table of URLs (its size is the
bound), whose n-grams of host and path are hashed apart. An empty host and path
have no n-grams; the verdict is then that of the intercept alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.tables import column, ship
from arrears.llm.words import bytes_of, grams, mix

# The rules of the query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: The labelled table: kinds of hosts and paths that a corpus does without, and ordinary ones. 1: block.
LABELLED = (
    ("http://www.casino-royal.example.com/en/slots", 1), ("https://win-casino.example.net/en/12", 1),
    ("https://online-casino.example.org/bonus", 1), ("http://free-bets.example.org/fr/90", 1),
    ("https://best-bets.example.com/en/odds", 1), ("http://m.bets-win.example.net/en/5", 1),
    ("https://poker-bonus.example.net/en/1", 1), ("http://cheap-pills.example.net/en/450", 1),
    ("https://pills-online.example.com/de/7", 1), ("https://cheap-meds.example.org/en/3", 1),
    ("http://www.cheap-watches.example.org/sale", 1), ("https://spam-farm.example.com/en/728", 1),
    ("https://link-farm.example.net/en/9", 1), ("http://spam-links.example.org/es/2", 1),
    ("https://ads-track.example.com/en/584", 1), ("https://ads.example.net/click/1", 1),
    ("http://track.ads-server.example.org/pixel", 1), ("https://adserver.example.com/banner/3", 1),
    ("https://click-track.example.org/en/1", 1), ("http://free-money.example.com/win", 1),
    ("https://hot-xxx.example.net/en/video", 1), ("http://porn-free.example.com/en/1", 1),
    ("https://payday-loans.example.com/apply", 1), ("http://free-download-crack.example.net/keygen", 1),
    ("https://www.library.example.com/en/450", 0), ("https://blog.garden.example.net/en/12.html", 0),
    ("https://news.example.org/fr/90?page=2", 0), ("http://museum.example.com/de/7/", 0),
    ("https://m.weather.example.net/en/5", 0), ("https://www.history.example.org/es/584", 0),
    ("http://blog.rivers.example.com/en/728", 0), ("https://school.example.net/en/9#top", 0),
    ("https://www.science.example.com/fr/3", 0), ("http://recipes.example.org/en/2.html", 0),
    ("https://m.travel.example.com/es/1", 0), ("https://blog.mountain.example.org/de/44", 0),
    ("https://theatre.example.net/en/853/", 0), ("http://www.university.example.org/en/25", 0),
    ("https://notes.example.com/en/671", 0), ("https://blog.teacher.example.com/en/369", 0),
    ("http://things.example.org/en/777", 0), ("https://other.example.org/en/685", 0),
    ("https://nation.example.com/en/676", 0), ("https://stations.example.net/es/797", 0),
    ("http://www.mathematics.example.org/en/97", 0), ("https://m.thought.example.com/fr/825", 0),
    ("https://earth.example.net/en/231", 0), ("https://blog.reader.example.org/en/618/", 0),
)

SIZES = (3, 4, 5)
BITS = 14
PENALTY = 0.02


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own_host, own_path = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(own_path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _cells(texts: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed n-gram) of every n-gram, with a mark before and after each text."""
    texts = pa.array(["\x02" + t + "\x03" if t else "" for t in texts.to_pylist()], pa.string())
    data, offsets = bytes_of(texts)
    owners, cells = [], []
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    for n in SIZES:
        own = grams(data.astype(np.uint64), n)
        same = text[: len(own)] == text[n - 1 : n - 1 + len(own)] if len(own) else np.zeros(0, bool)
        owners.append(text[: len(own)][same])
        cells.append((mix(own[same] + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(cells)


def _both(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, cell, weight): cells of host and path, each scaled to length 1 per text."""
    owner, cell = (np.concatenate(x) for x in zip(_cells(hosts, 1), _cells(paths, 2), strict=True))
    size = np.bincount(owner, minlength=len(hosts))
    return owner, cell, 1 / np.sqrt(np.maximum(size[owner], 1))


@dataclass
class UrlModel:
    weights: np.ndarray
    intercept: float

    def chance(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        """Probability that a URL is one to block."""
        owner, cell, value = _both(hosts, paths)
        z = self.intercept + np.bincount(owner, self.weights[cell] * value, minlength=len(hosts))
        return 1 / (1 + np.exp(-z))


def parts_of(url: str | None) -> tuple[str, str]:
    """Host and path of one URL, as ``host_of`` and ``path_of`` find them."""
    _, sep, rest = (url or "").partition("://")
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:end].translate({c: c + 32 for c in range(65, 91)})
    path = rest[end:].partition("#")[0].partition("?")[0]
    return (host, path) if sep else ("", "")


def train(labelled: list[tuple[str, int]] | tuple[tuple[str, int], ...], penalty: float = PENALTY, steps: int = 400) -> UrlModel:
    """Gradient descent on the logistic loss of a small table."""
    split = [parts_of(url) for url, _ in labelled]
    owner, cell, value = _both(pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()))
    y = np.array([label for _, label in labelled], np.float64)
    w, b = np.zeros(1 << BITS), 0.0
    for _ in range(steps):
        z = b + np.bincount(owner, w[cell] * value, minlength=len(y))
        off = 1 / (1 + np.exp(-z)) - y
        w -= 1.0 * (np.bincount(cell, off[owner] * value, minlength=len(w)) + penalty * w)
        b -= 0.1 * off.mean()
    return UrlModel(w, float(b))


def judged(
    pages: DataFrame,
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    labelled: list[tuple[str, int]] | tuple[tuple[str, int], ...] = LABELLED,
    threshold: float = 0.5,
) -> DataFrame:
    """``pages`` (as a struct ``page``) with host, path, rule, verdict and chance, the model's probability of block."""
    ship(pages.sparkSession)
    model = train(labelled)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chance = pa.array(model.chance(batch.column("host"), batch.column("path")), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, chance], names=[*batch.schema.names, "chance"])

    url = column(pages, url_col).cast("string")
    rows = pages.select(
        F.struct(*(column(pages, c) for c in pages.columns)).alias("page"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    chances = rows.mapInArrow(judge, T.StructType([*rows.schema.fields, T.StructField("chance", T.DoubleType())]))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("chance") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return chances.select("page", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "chance")

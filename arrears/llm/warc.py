"""WARC archives of captures, and one index over them in global order by URL key and time.

Writing: one record per capture. Of captures with equal payloads of at least
``LEAST_BYTES`` bytes, the one with the largest id is a response, the others are
revisits that refer to it and carry no payload; smaller payloads are always
responses. Archives are gzip files, written by Spark's text sink (two line ends
close a record, and are its separator), so they go wherever Spark can write.

Reading: each archive is parsed by its Content-Length fields, payload digests are
computed anew and compared with the header. Each archive gives a run of index
rows, sorted by (URL key, time, id).

Merging: splitters sampled from the runs cut the key space into ranges; within a
range, the pieces of the runs are merged by a loser tree. Ranges and places in
them give the global order. The range is cut by time and id as well, so one URL
with a third of all captures spans many ranges.

Null payloads count as empty, a null url as the empty string, a null id is written
as ``null`` and read back as null. Captures without a time get ``NO_TIME``. Rows
equal in id and payload are separate records; all of them are responses if their
id is the largest. Control characters of a url are percent-coded in its header.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.tables import column, ship, text_column, written

LEAST_BYTES = 1000
RECORDS_PER_FILE = 5000
NO_TIME = "1970-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def _uri(doc_id: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(">"))


def _headers(*fields: tuple[str, Column]) -> Column:
    lines = [F.concat(F.lit(f"\r\n{name}: "), value) for name, value in fields]
    return F.concat(F.lit(VERSION), *(F.coalesce(line, F.lit("")) for line in lines), F.lit(_END))


def records(captures: DataFrame, id_col: str, url_col: str, payload_col: str, time_col: str | None = None) -> DataFrame:
    """One column ``record``: the text of each capture's WARC record, without the line ends that close it."""
    payload = text_column(captures, payload_col)
    doc_id = column(captures, id_col)
    time = F.date_format(column(captures, time_col), "yyyy-MM-dd'T'HH:mm:ss'Z'") if time_col else F.lit(None).cast("string")
    safe = F.regexp_replace(text_column(captures, url_col), "\r", "%0D")
    safe = F.regexp_replace(F.regexp_replace(safe, "\n", "%0A"), "\x00", "%00")
    rows = captures.select(
        doc_id.alias("id"),
        safe.alias("url"),
        F.coalesce(time, F.lit(NO_TIME)).alias("time"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("content"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).alias("bytes"),
    )
    shared = (
        rows.where(F.col("bytes") >= LEAST_BYTES)
        .select("content", "id")
        .groupBy(F.col("content").alias("shared"))
        .agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    marked = rows.join(shared, F.col("content") == F.col("shared"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(_END),
    )
    common = [
        ("WARC-Record-ID", _uri(F.col("id"))),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Date", F.col("time")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ]
    response = F.concat(
        _headers(
            ("WARC-Type", F.lit("response")), *common,
            ("Content-Length", (F.octet_length(http) + F.col("bytes")).cast("string")),
        ),
        http, F.col("payload"),
    )
    again = F.concat(
        _headers(
            ("WARC-Type", F.lit("revisit")), *common,
            ("WARC-Profile", F.lit(REVISIT_PROFILE)),
            ("WARC-Refers-To", _uri(F.col("first_id"))),
            ("Content-Length", F.octet_length(http).cast("string")),
        ),
        http,
    )
    return marked.select(F.when(revisit, again).otherwise(response).alias("record"))


def write_archives(
    captures: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None
) -> None:
    rows = records(captures, id_col, url_col, payload_col, time_col)
    rows.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields in lower case, block) of each record of an archive's content."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:head_end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in lines:
            name, _, value = line.partition(":")
            fields[name.lower()] = value.strip()
        begin = head_end + 4
        end = begin + int(fields["content-length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, fields, archive[begin:end]
        at = end + 4


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the right, then path and query."""
    rest = url.partition("://")[2] or url
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:].partition("#")[0].lower()


_INDEX = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("time", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("archive", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])
_ARROW = pa.schema([
    *((c, pa.string()) for c in ("url_key", "time", "record_id", "archive")), ("offset", pa.int64()),
    *((c, pa.string()) for c in ("record_type", "url", "refers_to")), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``; those of one archive are a run sorted by (url_key, time, record_id).

    A revisit has no payload of its own: its bytes are null, its digest is the
    one it names.
    """
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                archive = batch.column(0)[i].as_py()
                rows = []
                for offset, fields, block in parse(gunzip(batch.column(1)[i].as_py())):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    named = fields["warc-payload-digest"].removeprefix("sha1:")
                    is_response = fields["warc-type"] == "response"
                    if is_response and hashlib.sha1(payload).hexdigest() != named:
                        raise ValueError(f"{archive}: the payload at byte {offset} is not the one its header names")
                    url = fields.get("warc-target-uri", "")
                    rows.append((
                        url_key(url), fields["warc-date"], fields["warc-record-id"], archive, offset, fields["warc-type"],
                        url, fields.get("warc-refers-to"), len(payload) if is_response else None, named,
                        payload if is_response and payloads else None,
                    ))
                rows.sort(key=lambda r: r[:3])
                columns = zip(*rows, strict=True) if rows else [[]] * len(_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(read, _INDEX)


class LoserTree:
    """Merge of k sorted runs: an inner node holds the loser of its match, the winner goes on to the top."""

    def __init__(self, runs: Sequence[Iterator[Any]]):
        self.runs = list(runs)
        self.heads = [next(run, None) for run in self.runs]
        k = len(self.runs)
        self.losers = [-1] * k
        for leaf in range(k):
            self._replay(leaf)

    def _before(self, a: int, b: int) -> bool:
        """An ended run loses to all; of equal heads the earlier run wins."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return (x, a) < (y, b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                # Its other side has not played yet.
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, Any]]:
        """(run, head) in order."""
        while self.runs:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield winner, head
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


def merge_runs(index: DataFrame) -> DataFrame:
    """All runs in one order: the columns of ``index`` with ``range`` and ``place``, by which the result is sorted globally."""
    names = index.columns
    at = {c: names.index(c) for c in ("archive", "url_key", "time", "record_id")}

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        archive, *key = (table.column(at[c]).to_pylist() for c in ("archive", "url_key", "time", "record_id"))
        runs: dict[str, list] = {}
        for row, own in enumerate(archive):
            runs.setdefault(own, []).append((key[0][row], key[1][row], key[2][row], row))
        # A shuffle may deliver the blocks of a run in any order; a run in order is found so in one pass.
        heads = [iter(sorted(run)) for _, run in sorted(runs.items())]
        order = pa.array([head[3] for _, head in LoserTree(heads)], pa.int64())
        merged = table.take(order)
        place = pa.array(range(len(merged)), pa.int64())
        shard = pa.array([TaskContext.get().partitionId()] * len(merged), pa.int64())
        yield from merged.append_column("range", shard).append_column("place", place).to_batches(max_chunksize=10_000)

    schema = T.StructType([*index.schema.fields, T.StructField("range", T.LongType()), T.StructField("place", T.LongType())])
    return index.repartitionByRange("url_key", "time", "record_id").mapInArrow(merge, schema)


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """The merged index of all archives below ``path``; a revisit has the bytes of the response that it refers to."""
    runs = written(read_archives(spark, path, payloads=False).drop("payload"), "capture-runs")
    sizes = (
        runs.where("record_type = 'response'").groupBy(F.col("record_id").alias("response"))
        .agg(F.max("payload_bytes").alias("response_bytes"))
    )
    return (
        merge_runs(runs)
        .join(sizes, F.col("refers_to") == F.col("response"), "left")
        .withColumn("payload_bytes", F.coalesce("payload_bytes", "response_bytes"))
        .drop("response", "response_bytes")
    )


def id_of(record_id: Column, kind: str = "long") -> Column:
    """The capture's id from its record id."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:capture:(.*)>$", 1), F.lit("null")).cast(kind)

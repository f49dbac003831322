"""Filter interaction audit by incremental retraction streaming.

Five filters judge whole texts; four look at one text alone, the fifth rejects a
text that some document with a smaller id has too. The audit counts documents by
the set (mask) of filters they fail, and everything it reports follows from those
counts.

1. A file stream takes the table in micro-batches, all that is there now. Column
   functions judge each text once and keep 32 bytes of it (SHA-256). Texts go
   neither to Python nor through a shuffle.
2. Each task merges its rows by text: rows that are not the smallest of their text
   there are rejected for good and only counted. So a text that a third of all
   rows share is a few rows a task.
3. The state of a text is its smallest id so far, with counts of the rows that
   have it. A smaller id takes its place: the earlier rows' mask is retracted from
   the part counters and added again with the fifth filter's bit. About
   ``TEXTS_PER_STATE`` texts share a row of the state store, by the first bits of
   their SHA-256; the number of bits follows the table's rows.
4. Each micro-batch appends its counter changes, one row a part, mask and label, to
   a folder of its own number; a repeated batch replaces its folder. Their sums
   are the counters.

Every change of the state is in the checkpoint folder: a lost executor or a
restarted query goes on from there. The state of a table of more than
``MOST_IN_MEMORY`` rows is kept in RocksDB, so it may outgrow the executors' memory;
smaller ones, about 100 bytes a text over all executors, are spared its files.

Null text, and null lang as the part, count as empty. A null id is never smaller
than another and has no smaller one. Rows with equal id and equal text do not
reject each other. Labels: a repeated id is good, or toxic, if any of its rows
is. An empty table gives no parts and so no rows. Columns that are not asked for
are not read.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations
from math import ceil, log2
from string import ascii_uppercase

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from arrears.llm.tables import column, ship, text_column, written
from arrears.session import work_dir

# The filters in the order of their bits, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10

#: Micro-batches that a table of many files is taken in, about.
BATCHES = 4

#: Texts that a task merges before it hands them on.
MOST_TEXTS = 1 << 17

#: Texts that share a row of the state store, about: each row costs a call of Python.
TEXTS_PER_STATE = 256

#: Rows of the table for each partition of the state, which has the session's shuffle partitions at most.
ROWS_PER_PARTITION = 20_000

#: Rows of a table whose state is kept in the executors' memory.
MOST_IN_MEMORY = 20_000_000

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COPY = 1 << FILTERS.index("E")
_ROW = "state_row long, digest binary, mask int, head boolean, doc_id long, part string, label int, n long"
_STATE = "digest array<binary>, least array<long>, text array<int>, part array<string>, label array<int>, n array<long>"
_CHANGE = "part string, label int, mask int, n long"


def mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    counts = F.struct(
        F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("distinct"), F.char_length(text).alias("chars"),
        F.char_length(F.translate(text, ascii_uppercase, "")).alias("others"), text.rlike("[#$%&*|]").alias("signs"),
    )
    # A struct in a list of one: the counts are taken once and used many times.
    return F.transform(F.array(counts), lambda c: sum(
        (F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate([
            c["words"] < LEAST_WORDS,
            100 * c["distinct"].cast("long") < LEAST_DISTINCT * c["words"].cast("long"),
            100 * (c["chars"] - c["others"]).cast("long") > MOST_CAPITALS * c["chars"].cast("long"),
            c["signs"],
        ])), F.lit(0),
    ))[0]


def _merge_texts(bits: int):
    """The function for ``mapInArrow`` that merges rows by text.

    It keeps those of a text's smallest id (``head``) and counts of those whose
    mask is final: rows without id, and, with mask E set, larger ids.
    """

    def out(merged: dict[tuple, int], least: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        summed: dict[tuple, int] = defaultdict(int)
        for (digest, mask, doc_id, part, label), n in merged.items():
            if doc_id is not None and doc_id != least[digest]:
                mask, doc_id = mask | _COPY, None
            summed[digest, mask, doc_id, part, label] += n
        rows = list(summed)
        for a in range(0, len(rows), 1 << 15):
            some = rows[a : a + (1 << 15)]
            digest, mask, doc_id, part, label = zip(*some, strict=True)
            yield pa.record_batch(
                [pa.array([int.from_bytes(d[:5], "big") >> (40 - bits) for d in digest], pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(mask, pa.int32()), pa.array([i is not None for i in doc_id], pa.bool_()),
                 pa.array([i or 0 for i in doc_id], pa.int64()), pa.array(part, pa.string()), pa.array(label, pa.int32()),
                 pa.array([summed[r] for r in some], pa.int64())],
                names=["state_row", "digest", "mask", "head", "doc_id", "part", "label", "n"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[tuple, int] = defaultdict(int)
        least: dict[bytes, int] = {}
        for batch in batches:
            for key in zip(*(batch.column(c).to_pylist() for c in ("digest", "mask", "doc_id", "part", "label")), strict=True):
                merged[key] += 1
                if key[2] is not None and key[2] < least.get(key[0], key[2] + 1):
                    least[key[0]] = key[2]
            if len(merged) >= MOST_TEXTS:
                yield from out(merged, least)
                merged.clear()
                least.clear()
        yield from out(merged, least)

    return merge


def retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counter changes of the texts of one state row: their new rows, and earlier ones once a smaller id arrives."""
    changes: dict[tuple, int] = defaultdict(int)
    least: dict[bytes, int] = {}
    kept: dict[bytes, dict[tuple, int]] = {}
    if state.exists:
        digests, ids, at, parts, labels, counts = state.get
        digests = [bytes(d) for d in digests]
        least = dict(zip(digests, ids, strict=True))
        for i, part, label, n in zip(at, parts, labels, counts, strict=True):
            kept.setdefault(digests[i], {})[part, label] = n
    for frame in frames:
        for digest, mask, head, doc_id, part, label, n in zip(
            *(frame[c].tolist() for c in ("digest", "mask", "head", "doc_id", "part", "label", "n")), strict=True
        ):
            if not head:
                changes[part, label, mask] += n
                continue
            digest, old = bytes(digest), least.get(digest)
            if old is not None and doc_id > old:
                changes[part, label, mask | _COPY] += n
                continue
            if old is None or doc_id < old:
                for (earlier, its_label), times in kept.get(digest, {}).items():
                    changes[earlier, its_label, mask] -= times
                    changes[earlier, its_label, mask | _COPY] += times
                least[digest], kept[digest] = doc_id, {}
            changes[part, label, mask] += n
            kept[digest][part, label] = kept[digest].get((part, label), 0) + n
    if least:
        digests = list(least)
        heads = [(i, part, label, n) for i, d in enumerate(digests) for (part, label), n in kept[d].items()]
        state.update((digests, [least[d] for d in digests], *map(list, zip(*heads, strict=True))))
    rows = [(*k, n) for k, n in changes.items() if n]
    if rows:
        part, label, mask, n = zip(*rows, strict=True)
        yield pd.DataFrame({"part": part, "label": label, "mask": mask, "n": n})


def _layout(spark: SparkSession, folder: str, rows: int) -> Row:
    """How the folder keeps its state, decided by its first table.

    ``bits`` of a text's digest name its state row, of about ``TEXTS_PER_STATE``
    texts; ``on_disk`` says whether the state is kept in RocksDB.
    """
    path, schema = f"{folder}/layout", "bits int, on_disk boolean"
    bits = max(0, min(40, ceil(log2(max(1, rows / TEXTS_PER_STATE)))))
    spark.createDataFrame([(bits, rows > MOST_IN_MEMORY)], schema).coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path).first()


def mask_counts(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    batches: int = BATCHES,
    folder: str | None = None,
) -> DataFrame:
    """part, label (1 for good, 2 for toxic, 3 for both), mask and n of the documents at ``path``.

    ``folder`` holds the checkpoint and the changes; with the one of an earlier
    call only files that came since are read. It must be one that all executors share.
    """
    ship(spark)
    folder = folder or f"{work_dir(spark)}/llm/interaction-{uuid.uuid4().hex}"
    flags = written(
        labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            (F.max((F.col("quality") == 1).cast("int")) + 2 * F.max((F.col("toxic") == 1).cast("int"))).alias("label")
        ).na.fill(0, ["label"]),
        "interaction-labels",
    )
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    n_rows = table.count()
    layout = _layout(spark, folder, n_rows)
    own = spark.newSession()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.shuffle.partitions", str(max(1, min(most, max(8, n_rows // ROWS_PER_PARTITION)))))
    if layout.on_disk:
        own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    flags = own.read.schema(flags.schema).parquet(flags.inputFiles()[0].rsplit("/", 1)[0]) if flags.inputFiles() else own.createDataFrame([], flags.schema)
    # The last letter in brackets makes the path a pattern: a stream does not take a single file's plain path.
    stream = own.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, ceil(files / batches))).parquet(f"{path[:-1]}[{path[-1]}]")
    rows = stream.select(
        column(stream, id_col).cast("long").alias("doc_id"), text_column(stream, part_col).alias("part"), text_column(stream, text_col).alias("text")
    )
    judged = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask(F.col("text")).alias("mask"))
    labelled = judged.join(flags, "doc_id", "left").select("digest", "mask", "doc_id", "part", F.coalesce("label", F.lit(0)).alias("label"))
    changes = labelled.mapInArrow(_merge_texts(layout.bits), _ROW).groupBy("state_row").applyInPandasWithState(
        retract, _CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout
    )

    def append(batch: DataFrame, number: int) -> None:
        batch.groupBy("part", "label", "mask").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    query = changes.writeStream.foreachBatch(append).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not query.lastProgress and not files:
        return spark.createDataFrame([], _CHANGE)
    counted = spark.read.schema(_CHANGE).parquet(f"{folder}/changes")
    return counted.groupBy("part", "label", "mask").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`mask_counts`.

    A document fails the mask's filters; each of them removes it in the orders
    where it comes first among them. That is the whole report as sums over at most
    32 masks a part.
    """
    total = lambda amount: F.sum(F.when(amount, F.col("n")).otherwise(0)).cast("long")
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = F.explode(F.array(*[F.lit(o) for o in orders])).alias("filter_order")
    by_order = counts.select("*", steps).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    place = lambda x: F.instr("filter_order", x)
    bits = lambda holds: sum((F.when(holds(x), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    # Of the orders of all filters, the share in which a filter comes first among k: one in k.
    failing = F.bit_count("mask")
    rows = by_order.withColumns({
        "before": bits(lambda x: place(x) < F.col("step")), "own": bits(lambda x: place(x) == F.col("step")),
    })
    removed_before = F.col("mask").bitwiseAND(F.col("before")) != 0
    failed = F.col("mask").bitwiseAND(F.col("own")) != 0
    removed = failed & ~removed_before
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~removed_before & ~failed).alias("kept"),
        total(removed).alias("removed"),
        total(failed & removed_before).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(removed & (F.col("label").bitwiseAND(1) != 0)).alias("good_lost"),
        total(removed & (F.col("label").bitwiseAND(2) != 0)).alias("toxic_lost"),
        F.sum(F.when(failed, F.col("n") * (F.lit(len(orders)) / failing).cast("long")).otherwise(0)).cast("long").alias("shapley"),
    )

"""Jaccard self-join on word n-grams, by MinHash banding.

1. One pass over the texts: words, the set of ``n`` consecutive words (a text of
   fewer words is one n-gram), MinHash values and band hashes. Texts with equal
   sets form one copy class; from here on each class is one node.
2. Nodes are shuffled on their band hashes. Bands and rows are chosen for the
   wanted recall at the threshold. Within a bucket, nodes whose MinHash values
   agree in too few places are apart; the rest are tied by a spanning forest.
3. The trees' components are the candidate groups. Full n-gram sets of their
   nodes are read again from the texts, and all pairs of a group are verified in
   blocks: a large bucket or group is cut into blocks, each pair of blocks is one
   unit of work of bounded size, and only counts and spanning links leave it.
4. Components of the verified links are the classes.

Nothing is capped: no bucket, group or partner list is cut. Work on a group
grows with the square of its number of *different* texts, in units that
spread over tasks; copies never count.

Texts without words (null, empty, signs only) have no n-grams and no links.
Rows equal in id and text are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.components import components, forest
from arrears.llm.tables import column, row_key, ship, written
from arrears.llm.words import find_words, grams, mix, slices

N = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 160
#: Pairs whose MinHash values agree in a smaller share than this much below the threshold are no candidates.
MARGIN = 0.2
#: Nodes in a block of a bucket; nodes and bytes of n-grams in a block of a candidate group.
BUCKET_BLOCK = 1024
GROUP_BLOCK = 1024
GROUP_BYTES = 8 << 20
FILTER_BITS = 24


def bands_for(threshold: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands find a pair at the threshold with the wanted chance."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def ngram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The set of n-gram hashes of each text, sorted."""
    words = find_words(texts)
    hashes = grams(words.hash, n)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(hashes[a : b - n + 1]))
        else:
            out.append(grams(words.hash[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def _minhash(sets: list[np.ndarray], n_hashes: int) -> np.ndarray:
    """MinHash values, one row for each set; all sets must have members."""
    rng = np.random.default_rng(5)
    factor = rng.integers(0, 2**32, n_hashes, dtype=np.uint32) | np.uint32(1)
    flip = rng.integers(0, 2**32, n_hashes, dtype=np.uint32)
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), n_hashes), np.uint32)
    for j in range(n_hashes):
        out[:, j] = np.minimum.reduceat((values ^ flip[j]) * factor[j], begin)
    return out


def _scan(rows: DataFrame, n: int, bands: int, per_band: int) -> DataFrame:
    """Per document: row, doc_id, key, its set's name and size, band hashes, and 16 bits of each MinHash value."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        base = np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                sets = ngram_sets(part.column(2), n)
                full = [i for i, s in enumerate(sets) if len(s)]
                names: list[bytes | None] = [None] * len(sets)
                band_lists: list = [None] * len(sets)
                sketches: list[bytes | None] = [None] * len(sets)
                if full:
                    values = _minhash([sets[i] for i in full], bands * per_band)
                    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(full), 1))
                    for j in range(per_band):
                        keys = mix(keys * base + values[:, j::per_band])
                    short = (values & np.uint32(0xFFFF)).astype(np.uint16)
                    for k, i in enumerate(full):
                        s = sets[i]
                        name = np.array([mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s ^ base)), len(s)], np.uint64)
                        names[i], band_lists[i], sketches[i] = name.tobytes(), keys[k].view(np.int64), short[k].tobytes()
                yield pa.record_batch(
                    [
                        pa.array(np.arange(row, row + len(sets)), pa.int64()), part.column(0), part.column(1),
                        pa.array(names, pa.binary()), pa.array(band_lists, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["row", "doc_id", "key", "set", "bands", "sketch"],
                )
                row += len(sets)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"row long, doc_id {kind}, key binary, set binary, bands array<long>, sketch binary"
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first ``keys`` columns, as one table each."""
    rest: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        same = np.ones(len(table) - 1, bool)
        for c in range(keys):
            values = table.column(c).to_numpy()
            same &= values[1:] == values[:-1]
        cuts = np.flatnonzero(~same) + 1
        begin = 0
        for cut in cuts.tolist():
            yield table.slice(begin, cut - begin)
            begin = cut
        rest = table.slice(begin)
    if rest is not None:
        yield rest


def _in_units(members: DataFrame, key: str, n_blocks: str) -> DataFrame:
    """Members copied to every unit of their group: one for each pair of its blocks, with the member's own block.

    They come in order of node, so trees are rooted at their smallest node, and
    units that share members mostly give the same links.
    """
    return (
        members.withColumn("block", F.pmod(F.xxhash64("node"), F.col(n_blocks)))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_blocks) - 1)))
        .withColumn("a", F.least("block", "other"))
        .withColumn("b", F.greatest("block", "other"))
        .repartition(F.col(key), "a", "b")
        .sortWithinPartitions(key, "a", "b", "node")
    )


def _bucket_edges(units: DataFrame, least: int) -> DataFrame:
    """Spanning forests of the nodes of each unit (key, a, b, node, sketch) that agree in ``least`` values."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, 3):
            if len(run) < 2:
                continue
            node = run.column("node").to_numpy()
            sketch = np.frombuffer(b"".join(run.column("sketch").to_pylist()), np.uint16).reshape(len(run), -1)
            agree = np.zeros((len(run), len(run)), np.uint16)
            for column in np.ascontiguousarray(sketch.T):
                agree += column[:, None] == column[None, :]
            root = forest(agree >= least)
            tied = root != np.arange(len(run))
            if tied.any():
                yield pa.record_batch([pa.array(node[tied]), pa.array(node[root[tied]])], names=["u", "v"])

    return units.select("band", "a", "b", "node", "sketch").mapInArrow(edges, "u long, v long")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of how many members each two sets have in common.

    Members that many sets have become bits of a row; the others are counted
    pair by pair.
    """
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    often = np.diff(np.concatenate([begin, [len(values)]]))
    common = np.flatnonzero(often > max(8, m // 16))
    for a in range(0, len(common), 4096):
        some = common[a : a + 4096]
        bits = np.zeros((m, -(-len(some) // 64) * 64), bool)
        for j, c in enumerate(some):
            bits[owner[begin[c] : begin[c] + often[c]], j] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(m):
            out[i] += np.bitwise_count(packed & packed[i]).sum(axis=1, dtype=np.int64)
    rare = np.setdiff1d(np.flatnonzero(often > 1), common, assume_unique=True)
    for times in np.unique(often[rare]).tolist():
        at = begin[rare[often[rare] == times]]
        who = owner[at[:, None] + np.arange(times)]
        for i in range(times):
            for j in range(i + 1, times):
                pair = np.bincount(who[:, i] * m + who[:, j], minlength=m * m).reshape(m, m) if len(at) * 4 > m * m else None
                if pair is not None:
                    out += pair + pair.T
                else:
                    np.add.at(out, (who[:, i], who[:, j]), 1)
                    np.add.at(out, (who[:, j], who[:, i]), 1)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _verified(units: DataFrame, threshold: float) -> DataFrame:
    """Per member of a unit (part, a, b, block, node, copies, grams): links it has there, and its tree's root."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, 3):
            node, block = run.column("node").to_numpy(), run.column("block").to_numpy()
            copies = run.column("copies").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in run.column("grams").to_pylist()]
            shared = shared_counts(sets)
            size = np.diag(shared)
            linked = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
            np.fill_diagonal(linked, False)
            if run.column("a")[0].as_py() != run.column("b")[0].as_py():
                linked &= block[:, None] != block[None, :]
            root = forest(linked)
            yield pa.record_batch(
                [pa.array(node), pa.array(linked @ copies), pa.array(node[root])], names=["node", "links", "root"]
            )

    return units.select("part", "a", "b", "block", "node", "copies", "grams").mapInArrow(
        verify, "node long, links long, root long"
    )


def _grams_of(rows: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """(key, grams) of the rows whose key is in ``keys``, from their texts.

    A bit array of fixed size lets few other rows through; the join with the
    keys, which follows, is exact.
    """
    cell = F.conv(F.substring(F.hex("key"), 1, FILTER_BITS // 4), 16, 10).cast("long")
    cells = keys.select(cell.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(bit, 64) AS INT))")).alias("set")
    ).toPandas()
    array = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    array[cells["cell"].to_numpy(np.int64)] = cells["set"].to_numpy(np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(array.view(np.uint64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            bit = np.array([int.from_bytes(k[: FILTER_BITS // 8], "big") for k in keys], np.uint64)
            wanted = (shared.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            batch = batch.filter(pa.array(wanted, pa.bool_()))
            for part in slices(batch, 1):
                sets = [s.tobytes() for s in ngram_sets(part.column(1), n)]
                yield pa.record_batch([part.column(0), pa.array(sets, pa.binary())], names=["key", "grams"])

    return rows.select("key", "text").mapInArrow(read, "key binary, grams binary")


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: doc_id, key (``row_key``), class_id, class_size, n_links, kept.

    Documents are linked when the Jaccard similarity of their n-gram sets
    reaches the threshold; ``n_links`` counts the linked documents, copies
    included. ``class_id`` is the smallest id that links lead to; that row is
    kept (null ids last, then the first row).
    """
    spark = docs.sparkSession
    ship(spark)
    bands, per_band = bands_for(threshold, recall)
    doc_id, text = column(docs, id_col), column(docs, text_col).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), row_key(doc_id, text).alias("key"), text.alias("text"))
    base = written(_scan(rows, n, bands, per_band), "sketches")
    nodes = written(
        base.where("set IS NOT NULL").groupBy("set").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies")),
        "nodes",
    )
    sketched = base.join(nodes.select("node", "copies"), F.col("row") == F.col("node"))

    banded = sketched.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = (
        banded.join(buckets, "band")
        .withColumn("n_blocks", F.ceil(F.col("size") / BUCKET_BLOCK))
        .join(base.select(F.col("row").alias("node"), "sketch"), "node")
    )
    least = math.floor((threshold - MARGIN) * bands * per_band)
    found = components(_bucket_edges(_in_units(members, "band", "n_blocks"), least))

    chosen = written(
        found.join(nodes.select("node", "copies"), "node").join(base.select(F.col("row").alias("node"), "key"), "node"),
        "candidates",
    )
    sets = _grams_of(rows, chosen, n).groupBy("key").agg(F.first("grams").alias("grams"))
    candidates = written(chosen.join(sets, "key").drop("key").withColumnRenamed("component", "part"), "candidate-sets")
    blocks = candidates.groupBy("part").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / GROUP_BLOCK), F.ceil(F.sum(F.length("grams")) / GROUP_BYTES)
        ).alias("n_blocks")
    )
    checked = written(_verified(_in_units(candidates.join(blocks, "part"), "part", "n_blocks"), threshold), "links")
    classes = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))

    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(links, "node", "left").join(classes, "node", "left").select(
        "set", "copies",
        F.coalesce("component", "node").alias("class"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
    of_rows = written(
        base.select("row", "doc_id", "key", "set").join(named, "set", "left").select(
            "row", "doc_id", "key",
            F.coalesce("class", "row").alias("class"),
            F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        ),
        "classes",
    )
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    sizes = of_rows.groupBy("class").agg(best.alias("best"), F.count(F.lit(1)).alias("class_size"))
    return of_rows.join(sizes, "class").select(
        "doc_id", "key",
        F.col("best.doc_id").alias("class_id"),
        "class_size", "n_links",
        (F.col("best.row") == F.col("row")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, columns as they are.

    Rows are found again by id and text; of rows equal in both, one stays.
    """
    kept = written(jaccard_classes(docs, id_col, text_col).groupBy("key").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")), "kept")
    key = row_key(column(docs, id_col), column(docs, text_col))
    keyed = F.struct(*(column(docs, c) for c in docs.columns)).alias("doc_row")
    rows = docs.select(key.alias("doc_key"), keyed)
    dropped = kept.where("NOT kept").select(F.col("key").alias("doc_key"))
    repeated = kept.where("kept AND times > 1").select(F.col("key").alias("doc_key"))
    fields = [F.col("doc_row").getField(c).alias(c) for c in docs.columns]
    single = rows.join(dropped.union(repeated), "doc_key", "left_anti").select(*fields)
    if repeated.isEmpty():
        # After exact deduplication there are none, and the texts need not be shuffled for them.
        return single
    once = rows.join(repeated, "doc_key").groupBy("doc_key").agg(F.first("doc_row").alias("doc_row"))
    return single.union(once.select(*fields))

"""Packing of tokenised documents into sequences, shortest pack first over the length histogram.

1. One pass tokenises whole texts, adds the end id and cuts a document into
   pieces of ``length`` ids and a rest. A piece carries its running number among
   the pieces of its length in its partition, and its ids as little-endian
   unsigned 32-bit numbers.
2. The histogram of piece lengths (``length`` rows at most) is all the driver
   sees. Lengths are placed longest first, each into the open pattern with the
   most room (the shortest pack), or into new sequences where that has too
   little; counts of patterns are updated, never single sequences. The result is
   a list of places: so many pieces of this length, the first of them at this
   offset of this sequence, the next in the next sequence. There are a few times
   as many places as lengths, whatever the number of documents.
3. A piece's rank within its length is the number of such pieces in earlier
   partitions plus its running number. The pieces of a length and partition have
   consecutive ranks, so their places are a few runs, found for those pairs
   alone; the pieces join their pair's runs. The ids are shuffled once, not
   sorted, and never go to Python again.

Null texts count as empty: they have the end id alone. Equal rows are packed
each by itself. An empty table gives no sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm.tables import column, ship, text_column, written
from arrears.llm.words import byte_table, bytes_of, hash_runs, slices

LENGTH = 4096
END_ID = 2

#: Words kept between batches by a Python worker; the store starts anew beyond.
MOST_WORDS = 1_000_000

# Texts of these characters only are cut into words here; all others go to the tokenizer as they are.
_PLAIN = re.compile("[\t-\r !-~¡-©«-¬®-±´¶-¸»¿-ÿ]*")
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[97:123], _CLASS[48:58], _CLASS[0xC3], _CLASS[0] = _LETTER, _DIGIT, _LETTER, 0
_LOWER = byte_table(lambda b: b != 32 and not 9 <= b <= 13)


def _pieces_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, first and last byte of each piece, and the first piece of each text.

    A piece is a run of letters, one digit, a run of other signs, or an
    apostrophe with the letters of a contraction. Texts must be plain.
    """
    data, offsets = bytes_of(texts)
    low = _LOWER[data]
    lead = np.flatnonzero(low == 0xC3)
    second = low[lead + 1]
    low[lead + 1] = np.where((second <= 0x9E) & (second != 0x97), second + 32, second)
    kind = _CLASS[low]
    kind[lead[(second == 0x97) | (second == 0xB7)]] = _SIGN
    tail = np.flatnonzero((low >= 0x80) & (low < 0xC0))
    kind[tail] = kind[tail - 1]
    inside = kind != 0
    start, end = inside.copy(), inside.copy()
    change = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    start[1:] &= change
    end[:-1] &= change
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    start[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    for i in np.flatnonzero((low == 39) & start & end).tolist():
        if i + 1 == len(low) or not inside[i + 1] or i + 1 in edges:
            continue
        after = low[i + 1 : i + 3].tobytes()
        n = 1 if after[:1] in (b"s", b"t", b"m", b"d") else 2 if after in (b"re", b"ve", b"ll") else 0
        if not n or n == 2 and end[i + 1]:
            continue
        end[i], start[i + 1] = False, False
        if not end[i + n]:
            end[i + n], start[i + n + 1] = True, True
    starts = np.flatnonzero(start)
    return low, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


class WordTokenizer:
    """Ids of whole texts by a word-level BPE tokenizer, each distinct word tokenised once.

    It holds for a lower-casing tokenizer whose words end in a ``</w>`` token,
    which shows where a word ends when many are tokenised together. Texts with
    characters beyond Latin-1, or with a special token's string, take the
    tokenizer's own path. Words are known by their 64-bit hash, in an
    open-addressing table.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.bits = (2 * MOST_WORDS).bit_length()
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(1 << self.bits, np.uint64)
        self.number = np.zeros(1 << self.bits, np.int32)
        self.n = 0
        self.ids = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes, -1 for new ones."""
        out = np.full(len(hashes), -1, np.int64)
        todo, at = np.arange(len(hashes)), (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            there = self.key[at]
            hit = there == hashes[todo]
            out[todo[hit]] = self.number[at[hit]]
            go = ~hit & (there != 0)
            todo, at = todo[go], (at[go] + 1) & (len(self.key) - 1)
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        some = [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        ids = np.concatenate(ids)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the tokenizer does not end every word with </w>")
        todo, at = np.arange(len(hashes)), (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = self.key[at] == 0
            self.key[at[free]] = hashes[todo[free]]
            done = self.key[at] == hashes[todo]
            self.number[at[done]] = self.n + todo[done]
            todo, at = todo[~done], (at[~done] + 1) & (len(self.key) - 1)
        self.n += len(words)
        self.begin = np.concatenate([self.begin, stops + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        strings = texts.to_pylist()
        plain = [bool(_PLAIN.fullmatch(t)) and not (self.special and self.special.search(t)) for t in strings]
        low, starts, ends, first = _pieces_of(texts.filter(pa.array(plain, pa.bool_())))
        hashes = hash_runs(low, starts, ends) | np.uint64(1)
        at = self._find(hashes)
        new, where = np.unique(hashes[at < 0], return_index=True)
        if len(new):
            if self.n + len(new) > MOST_WORDS and self.n:
                self._clear()
                return self.encode(texts)
            if len(new) > MOST_WORDS:
                return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in strings]
            where = np.flatnonzero(at < 0)[where]
            self._learn(new, [low[s:e].tobytes().decode() for s, e in zip(starts[where], ends[where], strict=True)])
            at = self._find(hashes)
        size = self.begin[at + 1] - self.begin[at]
        stop = np.cumsum(size)
        flat = self.ids[np.repeat(self.begin[at] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
        edges = np.concatenate([[0], stop])[first]
        cut = iter([flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)])
        return [
            next(cut) if is_plain else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
            for is_plain, t in zip(plain, strings, strict=True)
        ]


_tokenizers: dict[int, WordTokenizer] = {}


def _tokenizer(model: str) -> WordTokenizer:
    """One per Python worker and model, so that its words last from batch to batch."""
    key = zlib.crc32(model.encode())
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = WordTokenizer(model)
    return _tokenizers[key]


def place_lengths(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(piece length, first rank, count, first sequence, offset), by length and rank.

    Sequences of one pattern have consecutive numbers, so a pattern is a range of
    sequences and its fill; a place takes a range or its beginning.
    """
    places = []
    open_by_room: list[tuple[int, int, int]] = []  # room, first sequence, count
    next_sequence = 0
    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            if open_by_room and open_by_room[-1][0] >= size:
                room, first, count = open_by_room.pop()
            else:
                room, first, count = length, next_sequence, left
                next_sequence += left
            taken = min(left, count)
            places.append((size, rank, taken, first, length - room))
            if count > taken:
                insort(open_by_room, (room, first + taken, count - taken))
            if room > size:
                insort(open_by_room, (room - size, first, taken))
            left, rank = left - taken, rank + taken
    return places


def _pieces(docs: DataFrame, model: str, length: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Pieces with ids' CRC-32, and per partition a running number within the length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for some in slices(batch, 1, 2 << 20):
                ids = _tokenizer(shared.value).encode(some.column(1))
                owner, start, size, check, total, number, kept = [], [], [], [], [], [], []
                for i, own in enumerate(ids):
                    own = np.append(own, np.uint32(end_id)).astype("<u4")
                    for a in range(0, len(own), length):
                        piece = own[a : a + length]
                        owner.append(i)
                        start.append(a)
                        size.append(len(piece))
                        check.append(zlib.crc32(piece.tobytes()))
                        total.append(len(own))
                        number.append(seen[len(piece)])
                        seen[len(piece)] += 1
                        if keep_ids:
                            kept.append(piece.tobytes())
                columns = [some.column(0).take(pa.array(owner, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, size, check, total))]
                columns += [pa.array(np.full(len(owner), part), pa.int64()), pa.array(number, pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "number"]
                if keep_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part long, number long"
    return docs.mapInArrow(cut, schema + (", ids binary" if keep_ids else ""))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, its ids.

    ``ids`` is binary: the ids as little-endian unsigned 32-bit numbers.
    ``tokenizer_path`` is read on the driver; executors get its content.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        model = file.read()
    rows = docs.select(column(docs, id_col).alias("doc_id"), text_column(docs, text_col).alias("text"))
    pieces = written(_pieces(rows, model, length, end_id, keep_ids), "pieces")
    per_part = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = place_lengths(histogram, length)

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pairs = per_part.select("length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # Not for broadcast: it has rows for every partition, and its files look smaller than it is.
    runs = _runs(spark, pairs, places).hint("shuffle_hash")
    run = F.element_at(F.filter("runs", lambda r: r["number"] <= F.col("number")), -1)
    return pieces.join(runs, ["length", "part"]).withColumn("run", run).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("run.sequence_id") + F.col("number") - F.col("run.number")).alias("sequence_id"),
        F.col("run.offset").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def checksums(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` taken from the ``ids`` they hold, which are left out."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _runs(spark: SparkSession, pairs: DataFrame, places: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """length, part and the runs of that pair's pieces: first number, its sequence and the offset of all.

    A run is a place, or the part of one, that the pair's ranks fall into.
    """
    shared = spark.sparkContext.broadcast(np.array(places, np.int64).reshape(-1, 5))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, count, sequence, offset = shared.value.T
        for batch in batches:
            found = []
            for own, n, before in zip(*(batch.column(c).to_pylist() for c in ("length", "n", "before")), strict=True):
                a, b = np.searchsorted(-size, [-own, -own + 1])  # places lie by falling length, then by rank
                a += np.searchsorted(first[a:b] + count[a:b], before, "right")
                b -= (b - a) - np.searchsorted(first[a:b], before + n, "left")
                numbers = np.maximum(first[a:b] - before, 0)
                found.append([
                    {"number": x, "sequence_id": y, "offset": z}
                    for x, y, z in zip(numbers.tolist(), (sequence[a:b] + before + numbers - first[a:b]).tolist(), offset[a:b].tolist(), strict=True)
                ])
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("number", "sequence_id", "offset")]))
            yield pa.record_batch([batch.column("length"), batch.column("part"), pa.array(found, kind)], names=["length", "part", "runs"])

    return pairs.mapInArrow(runs, "length long, part long, runs array<struct<number: long, sequence_id: long, offset: long>>")

"""Packing documents into windows of a set length by best-fit decreasing, over the whole corpus at once.

A document's ids are cut into full windows first; what remains is one piece. Pieces of equal length are alike, so the
packing needs no more than the number of pieces of each length: at most `size` numbers, however large the corpus is.
Lengths go in falling order. A segment tree indexed by remaining capacity finds the tightest open window; as all open
windows of one capacity are alike, whole ranges of them take their pieces in one step. The result is a short list of
placements (a range of the pieces of one length to a range of windows), and each piece finds its window by its length
and its place among the pieces of that length. No piece is gathered or sorted.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emberline.llm.encoding import Definition, encoder
from emberline.llm.texts import chunks, reach_package
from emberline.session import stage

SIZE, END = 2048, 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
PLACEMENTS = "_length long, _from long, _to long, _window long, _per long, _offset long"


class OpenWindows:
    """Ranges of open windows by remaining capacity, under a segment tree that counts the ranges of each capacity."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _count(self, room: int, step: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += step
            node >>= 1

    def add(self, room: int, first: int, many: int) -> None:
        if room and many:
            self.ranges[room].append((first, many))
            self._count(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self.ranges[room].pop()

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of an open window that is no smaller than `least`."""
        node = self.leaves + least
        if self.tree[node]:
            return least
        # Up to the first subtree on the right that holds a window, then down to its leftmost one.
        while node > 1 and (node & 1 or not self.tree[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node *= 2
            node += not self.tree[node]
        return node - self.leaves


@dataclass
class Packed:
    """Placements (length, from, to, window, per, offset): the pieces number from to `to` - 1 of a length go to `window`
    and the windows after it, `per` pieces in each, one behind the other from `offset` on."""

    rows: list[tuple[int, ...]] = field(default_factory=list)
    windows: int = 0


def best_fit(counts: dict[int, int], size: int = SIZE) -> Packed:
    """Best-fit decreasing of so many pieces of each length.

    A window that takes a piece and has room for another of that length is then the tightest one: it takes all that
    fit. So does each window of its range, until the pieces run out.
    """
    out, free = Packed(), OpenWindows(size)
    for length in sorted(counts, reverse=True):
        nth, count = 0, counts[length]
        while nth < count:
            room = free.tightest(length)
            if room is None:
                room, first = size, out.windows
                many = -(-(count - nth) // (size // length))
                out.windows += many
            else:
                first, many = free.take(room)
            per = room // length
            full = min(many, (count - nth) // per)
            if full:
                out.rows.append((length, nth, nth + full * per, first, per, size - room))
                free.add(room - per * length, first, full)
                nth += full * per
            if full < many and nth < count:  # the last pieces fill a part of one window more
                rest = count - nth
                out.rows.append((length, nth, count, first + full, rest, size - room))
                free.add(room - rest * length, first + full, 1)
                nth, full = count, full + 1
            free.add(room, first + full, many - full)
    return out


def _cutter(files, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(files.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                owner, start, length, crc, total = [], [], [], [], []
                for i, text in enumerate(texts.to_pylist()):
                    ids = np.append(ids_of(text or ""), np.uint32(end)).astype("<u4")
                    data = memoryview(ids.tobytes())
                    for lo in range(0, len(ids), size):
                        piece = data[4 * lo : 4 * (lo + size)]
                        owner.append(i)
                        start.append(lo)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(ids))
                long = np.array(length, np.int64)
                # The place of each piece among those of its length in this task.
                order = np.argsort(long, kind="stable")
                first = np.flatnonzero(np.diff(long[order], prepend=-1))
                many = np.diff(np.append(first, len(order)))
                nth = np.zeros(len(order), np.int64)
                nth[order] = np.arange(len(order)) - np.repeat(first, many) + seen[long[order]]
                seen[long[order][first]] += many
                columns = [batch.column(0).slice(at, len(texts)).take(pa.array(owner, pa.int64())), start, long, crc, total]
                columns += [np.full(len(order), part, np.int32), nth]
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in PIECES.split(", ")])

    return run


def pack(docs: DataFrame, files: Definition, size: int = SIZE, end: int = END) -> DataFrame:
    """Per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text, null being empty, and `end`; so every document has a piece at least. Each
    row of `docs` is a document: repeated rows and rows without a doc_id are packed like others. Sequences are numbered
    from 0, and their pieces lie one behind the other from offset 0. An empty table gives an empty result; other
    columns are not looked at. The result is a written table: which of the pieces of one length goes to which window
    follows the tasks that the documents came in, how many windows there are does not.
    """
    spark = docs.sparkSession
    reach_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = rows.mapInArrow(_cutter(spark.sparkContext.broadcast(files), size, end), PIECES)
    pieces = stage(cut, "pack-pieces")
    tallies = stage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "pack-tallies")
    counts = tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()  # `size` rows at most
    placed = best_fit({r["length"]: r["n"] for r in counts}, size)
    # The number of placements is bounded by `size`, not by the corpus.
    placements = spark.createDataFrame(placed.rows, PLACEMENTS)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    leads = tallies.select("part", "length", F.coalesce(before, F.lit(0)).alias("_lead"))
    found = pieces.join(leads, ["part", "length"]).withColumn("_nth", F.col("nth") + F.col("_lead"))
    here = (F.col("length") == F.col("_length")) & (F.col("_nth") >= F.col("_from")) & (F.col("_nth") < F.col("_to"))
    place = F.col("_nth") - F.col("_from")
    return stage(
        found.join(F.broadcast(placements), here).select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("_window") + F.expr("(_nth - _from) div _per")).alias("sequence_id"),
            (F.col("_offset") + place % F.col("_per") * F.col("length")).alias("offset"),
        ),
        "packed",
    )

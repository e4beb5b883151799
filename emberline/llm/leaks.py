"""Benchmark decontamination by a prefix-filtered set join of item windows and documents.

A window of an item is found in a document only if all its shingles are. So one shingle is the necessary prefix for
containment in full, and the rarest one in the corpus is taken: shingles are ordered by the number of documents that
hold them. Documents meet windows at these prefix shingles alone. The place of the shingle in the window bounds where
the window can start, the lengths bound where it can end, and what is left is compared word by word.

Items come in blocks of a set size. The block is sent to the tasks, every document is read against it, and no document
crosses a shuffle; a larger benchmark takes more blocks.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from emberline.llm.texts import PLAIN_WORDS, Known, Words, add_columns, chunks, reach_package, words
from emberline.session import stage

WINDOW, SHINGLE = 10, 5
#: Windows sent to the tasks at once: about 60 MB.
BLOCK = 1 << 18


@dataclass
class Block:
    """Distinct windows: their words' hashes (a row each, zero beyond the length), lengths, bytes and items."""

    hashes: np.ndarray
    lengths: np.ndarray
    texts: list[bytes]
    items: list[list[str]]

    def shingle_size(self) -> np.ndarray:
        return np.minimum(self.lengths, SHINGLE)

    def shingles(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """By shingle size and offset: the windows that have one there, and its hash."""
        for size in np.unique(self.shingle_size()).tolist():
            rows = np.flatnonzero(self.shingle_size() == size)
            for offset in range(WINDOW):
                at = rows[self.lengths[rows] - size >= offset]
                if len(at):
                    flat = np.ascontiguousarray(self.hashes[at, offset : offset + size]).ravel()
                    n = len(at) * size
                    whole = Words(np.zeros(0, np.uint8), np.zeros(n), np.zeros(n), np.array([0, n]), np.zeros(2, int))
                    yield size, offset, at, whole.window_hashes(size, flat)[::size]


def item_windows(benchmark: DataFrame, k: int = WINDOW) -> DataFrame:
    """item (its id as text), window (words joined by blanks): k consecutive words, or all of a shorter item."""
    reach_package(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                found, ids = words(texts, PLAIN_WORDS, fold=True), batch.column(0).slice(at, len(texts)).to_pylist()
                items, windows = [], []
                for i, item in enumerate(ids):
                    lo, hi = int(found.bounds[i]), int(found.bounds[i + 1])
                    for start in range(lo, max(lo + (hi > lo), hi - k + 1)):
                        items.append(item)
                        windows.append(found.joined(start, min(start + k, hi)).decode())
                    if len(windows) > 100_000:
                        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.string())], names=["item", "window"])
                        items, windows = [], []
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.string())], names=["item", "window"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return rows.mapInArrow(run, "item string, window string").distinct()


def _block(rows: list) -> Block:
    by_window: dict[str, list[str]] = {}
    for row in rows:
        by_window.setdefault(row["window"], []).append(row["item"])
    texts = sorted(by_window)
    found = words(pa.array(texts, pa.string()), PLAIN_WORDS)
    hashes = np.zeros((len(texts), WINDOW), np.uint64)
    lengths = found.counts
    at = np.arange(len(found.starts))
    owner = found.text_of(at) if len(at) else at
    hashes[owner, at - found.bounds[owner]] = found.hashes()
    return Block(hashes, lengths, [t.encode() for t in texts], [sorted(by_window[t]) for t in texts])


def _frequencies(docs: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """By shingle size: hashes of the block's shingles with the number of documents that hold each (two columns)."""
    known: dict[int, list[np.ndarray]] = {}
    for size, _, _, hashes in block.shingles():
        known.setdefault(size, []).append(hashes)
    shared = docs.sparkSession.sparkContext.broadcast({s: Known(np.concatenate(h)) for s, h in known.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {size: np.zeros(len(k.keys), np.int64) for size, k in shared.value.items()}
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                found = words(texts, PLAIN_WORDS, fold=True)
                hashes = found.hashes()
                for size, k in shared.value.items():
                    inside = found.inside(size)
                    if len(inside):
                        at, nth = k.find(found.window_hashes(size, hashes)[inside])
                        pairs = np.unique(found.text_of(inside[at]) * len(k.keys) + nth)
                        np.add.at(sums[size], pairs % max(1, len(k.keys)), 1)
        for size, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), size, np.int32)),
                    pa.array(shared.value[size].keys[some].view(np.int64)),
                    pa.array(total[some]),
                ],
                names=["size", "shingle", "n"],
            )

    counted = docs.select("text").mapInArrow(run, "size int, shingle long, n long")
    rows = counted.groupBy("size", "shingle").agg(F.sum("n").alias("n")).collect()  # one row a shingle of the block
    out = {}
    for size, k in shared.value.items():
        total = dict((r["shingle"], r["n"]) for r in rows if r["size"] == size)
        out[size] = np.array([total.get(int(h), 0) for h in k.keys.view(np.int64)], np.int64)
    return {size: (shared.value[size].keys, n) for size, n in out.items()}


@dataclass
class Index:
    """By shingle size: the prefix shingles, and the (window, offset) pairs of each, in rows from[i] : from[i + 1]."""

    block: Block
    known: dict[int, Known]
    first: dict[int, np.ndarray]
    windows: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]


def _index(block: Block, frequencies: dict[int, tuple[np.ndarray, np.ndarray]]) -> Index:
    """The prefix of each window: its rarest shingle, the least hash if there are several."""
    n = len(block.texts)
    count, best, offset = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for size, at_offset, rows, hashes in block.shingles():
        keys, sums = frequencies[size]
        rarity = sums[np.searchsorted(keys, hashes)]
        better = (rarity < count[rows]) | ((rarity == count[rows]) & (hashes < best[rows]))
        rows, hashes, rarity = rows[better], hashes[better], rarity[better]
        count[rows], best[rows], offset[rows] = rarity, hashes, at_offset
    index = Index(block, {}, {}, {}, {})
    # A window none of whose shingles occurs cannot be found; it stays out.
    for size in frequencies:
        rows = np.flatnonzero((block.shingle_size() == size) & (count > 0))
        rows = rows[np.argsort(best[rows], kind="stable")]
        index.known[size] = Known(best[rows])
        index.first[size] = np.searchsorted(best[rows], np.append(index.known[size].keys, np.uint64(2**64 - 1)))
        index.first[size][-1] = len(rows)
        index.windows[size], index.offsets[size] = rows, offset[rows]
    return index


def _occurrences(index: Index, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Start word and window number of every occurrence of a window in the chunk."""
    hashes = found.hashes()
    starts, windows = [], []
    for size, known in index.known.items():
        inside = found.inside(size)
        if not len(inside):
            continue
        at, nth = known.find(found.window_hashes(size, hashes)[inside])
        first = index.first[size]
        many = first[nth + 1] - first[nth]
        row = np.repeat(first[nth] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        window = index.windows[size][row]
        place = np.repeat(inside[at], many)
        start = place - index.offsets[size][row]
        text = found.text_of(place)
        # Positional and length bounds: the window starts and ends within the text.
        fits = (start >= found.bounds[text]) & (start + index.block.lengths[window] <= found.bounds[text + 1])
        start, window = start[fits], window[fits]
        for j in range(WINDOW):
            long_enough = index.block.lengths[window] > j
            same = ~long_enough | (hashes[np.minimum(start + j, len(hashes) - 1)] == index.block.hashes[window, j])
            start, window = start[same], window[same]
        exact = [
            found.joined(s, s + int(index.block.lengths[w])) == index.block.texts[w]
            for s, w in zip(start.tolist(), window.tolist(), strict=True)
        ]
        exact = np.array(exact, bool)
        starts.append(start[exact])
        windows.append(window[exact])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(windows)


HITS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))


def contamination(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """`docs` with n_words, hits (runs of hit words, end exclusive) and items (ids with an occurring window, sorted).

    Windows have 10 words; a shorter item is one window; an item or document that is null or has no word takes no
    part. Items without an id are called `null`, repeated item ids count once. Repeated documents come out alike.
    Without any item every document is clean; an empty table of documents stays empty. Columns of these names are
    replaced.
    """
    spark = docs.sparkSession
    reach_package(spark)
    windows = stage(item_windows(benchmark), "leak-windows")
    blocks = max(1, -(-windows.count() // block))
    fields = [StructField("n_words", LongType(), False), StructField("hits", HITS, False), StructField("items", ArrayType(StringType()), False)]
    rows = docs
    for nth in range(blocks):
        part = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == nth)
        table = _block(part.collect())  # at most about `block` rows
        shared = spark.sparkContext.broadcast(_index(table, _frequencies(docs, table)))

        def compute(texts: pa.Array, *before: pa.Array, shared=shared) -> list[list]:
            found = words(texts, PLAIN_WORDS, fold=True)
            start, window = _occurrences(shared.value, found)
            edge = np.zeros(len(found.starts) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + shared.value.block.lengths[window], -1)
            items: list[set[str]] = [set() for _ in range(len(texts))]
            for text, w in zip(found.text_of(start).tolist(), window.tolist(), strict=True):
                items[text].update(shared.value.block.items[w])
            if before:
                for i, (old, named) in enumerate(zip(before[0].to_pylist(), before[1].to_pylist(), strict=True)):
                    items[i].update(named)
                    for run in old:
                        edge[found.bounds[i] + run["start"]] += 1
                        edge[found.bounds[i] + run["end"]] -= 1
            hit = np.cumsum(edge)[:-1] > 0
            hits: list[list[dict]] = [[] for _ in range(len(texts))]
            some = np.flatnonzero(hit)
            if len(some):
                text = found.text_of(some)
                new = np.flatnonzero((np.diff(some, prepend=-2) > 1) | (np.diff(text, prepend=-1) > 0))
                for a, b in zip(new.tolist(), np.append(new[1:], len(some)).tolist(), strict=True):
                    i, lo = int(text[a]), int(found.bounds[text[a]])
                    hits[i].append({"start": int(some[a]) - lo, "end": int(some[b - 1]) + 1 - lo})
            return [found.counts.tolist(), hits, [sorted(s) for s in items]]

        rows = add_columns(rows, "text", fields, compute, ("hits", "items") if nth else ())
    return rows


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, the digest of the item ids, contaminated."""
    found = contamination(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )

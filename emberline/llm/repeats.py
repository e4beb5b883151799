"""Substring dedup: windows of words that start in an earlier document are cut out, as maximal intervals.

Every window of `k` consecutive words gets a Rabin-Karp hash. A task folds its own windows first: of equal ones only
those of its smallest doc_id travel on, the others are repeats already. What is left is dealt by hash to buckets of a
set size, a partition each, packed as runs of bytes, and each bucket finds the smallest doc_id of each hash. The windows
that lie in a later document go back to it as word places; there they merge into maximal intervals, and the rest is kept.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from emberline.llm.texts import add_columns, chunks, mix, reach_package, words

WINDOW = 50
#: Windows that a task folds at once, and about as many as a bucket holds: they bound the memory of a task.
FOLD, BUCKET = 1_000_000, 2_000_000
#: A bucket per so many bytes of text, if a word takes six.
BUCKET_BYTES = 6 * BUCKET
LAST = np.iinfo(np.int64).max  # stands for a missing doc_id: no document is later

PACKED = "bucket int, hashes binary, ids binary, keys binary, counts binary, places binary"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in seven bits a byte, low bits first, and the bytes that each takes."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28, 35, 42, 49, 56, 63):
        sizes += values >> np.uint64(bits) > 0
    out = np.zeros(sizes.sum(), np.uint8)
    first = np.cumsum(sizes) - sizes
    for nth in range(int(sizes.max(initial=0))):
        more = np.flatnonzero(sizes > nth)
        seven = (values[more] >> np.uint64(7 * nth)) & np.uint64(127)
        out[first[more] + nth] = seven.astype(np.uint8) | np.where(sizes[more] > nth + 1, 128, 0).astype(np.uint8)
    return out, sizes


def unpack(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of `pack`, and the place of each one's first byte."""
    last = np.flatnonzero(data < 128)
    first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    values = np.zeros(len(last), np.uint64)
    sizes = last - first + 1
    for nth in range(int(sizes.max(initial=0))):
        more = np.flatnonzero(sizes > nth)
        values[more] |= (data[first[more] + nth].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * nth)
    return values.astype(np.int64), first


def _steps(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Differences to the value before; `first` marks the places that start anew."""
    out = np.diff(values, prepend=0)
    out[first] = values[first]
    return out


def _sums(steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Back from `_steps`."""
    total = np.cumsum(steps)
    lead = total[first] - steps[first]
    return total - np.repeat(lead, np.diff(np.append(first, len(steps))))


def _smallest(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a smaller id has the same hash."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else order
    del ordered
    ids = ids[order]
    least = np.minimum.reduceat(ids, first) if len(first) else ids
    later = np.zeros(len(hashes), bool)
    later[order] = ids > np.repeat(least, np.diff(np.append(first, len(ids))))
    return later


def _emitter(k: int, buckets: int):
    def packed(rows: dict[str, list], bucket: int, hashes, row, place, ids, keys) -> None:
        """One packed row: documents in order, their ids, keys and counts, and the steps between places."""
        first = np.flatnonzero(np.diff(row, prepend=-1))
        docs = row[first]
        rows["bucket"].append(bucket)
        rows["hashes"].append(None if hashes is None else hashes.tobytes())
        rows["ids"].append(ids[docs].tobytes())
        rows["keys"].append(keys[docs].tobytes())
        rows["counts"].append(pack(np.diff(np.append(first, len(row))))[0].tobytes())
        rows["places"].append(pack(_steps(place, first))[0].tobytes())

    def fold(parts, ids, keys) -> Iterator[pa.RecordBatch]:
        hashes, row, place = (np.concatenate(p) for p in zip(*parts, strict=True))
        parts.clear()  # from here on the windows are held once
        ids, keys = np.concatenate(ids), np.concatenate(keys)
        later = _smallest(hashes, ids[row])
        rows: dict[str, list] = {f.split()[0]: [] for f in PACKED.split(", ")}
        if later.any():
            at = np.flatnonzero(later)
            packed(rows, int(hashes[at[0]] % np.uint64(buckets)), None, row[at], place[at], ids, keys)
        at = np.flatnonzero(~later)
        bucket = ((hashes[at] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        at = at[np.argsort(bucket, kind="stable")]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets))))
        for nth in np.flatnonzero(np.diff(bounds)).tolist():
            own = at[bounds[nth] : bounds[nth + 1]]
            packed(rows, nth, hashes[own], row[own], place[own], ids, keys)
        kinds = [pa.int32()] + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ids, keys, held, docs = [], [], [], 0, 0
        for batch in batches:
            for at, texts in chunks(batch.column(2)):
                found = words(texts)
                inside = found.inside(k)
                ids.append(batch.column(0).slice(at, len(texts)).fill_null(LAST).to_numpy(zero_copy_only=False))
                keys.append(batch.column(1).slice(at, len(texts)).to_numpy(zero_copy_only=False).astype(np.int64))
                if len(inside):
                    hashes = found.window_hashes(k)
                    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.maximum(found.counts - k + 1, 0))
                    place = (inside - found.bounds[row]).astype(np.int32)
                    for lo in range(0, len(inside), FOLD):  # a very long text is folded piece by piece
                        cut = slice(lo, lo + FOLD)
                        parts.append((hashes[inside[cut]], row[cut] + docs, place[cut]))
                        held += len(inside[cut])
                        if held >= FOLD:
                            yield from fold(parts, ids, keys)
                            parts, held = [], 0
                docs += len(texts)
                if not parts:
                    ids, keys, docs = [], [], 0
        if parts:
            yield from fold(parts, ids, keys)

    return run


#: Places of repeated windows: of many documents in a row on the way to them, of one in a row at last.
DEALT = "deal int, ids binary, keys binary, counts binary, places binary"
MARKS = "doc_id long, key long, places binary"


def _by_document(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First entry of each document, packed places, and where a document's places begin; `row` is in order."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    data, sizes = pack(_steps(place, first))
    return first, data, np.concatenate(([0], np.cumsum(sizes)))[np.append(first, len(row))]


def _dealt(deals: int, ids, keys, row, place) -> pa.RecordBatch:
    """Places packed for all documents that are dealt to one place; `row` need not be in order."""
    spread = (mix(ids.view(np.uint64)) % np.uint64(deals)).astype(np.int32)
    order = np.lexsort((place, row, spread[row]))
    row, place = row[order], place[order]
    deal = spread[row]
    out: list[list] = [[], [], [], [], []]
    bounds = np.searchsorted(deal, np.arange(deals + 1))
    for nth in np.flatnonzero(np.diff(bounds)).tolist():
        cut = slice(bounds[nth], bounds[nth + 1])
        first, data, _ = _by_document(row[cut], place[cut])
        docs = row[cut][first]
        counts = pack(np.diff(np.append(first, len(row[cut]))))[0]
        made = (nth, ids[docs].tobytes(), keys[docs].tobytes(), counts.tobytes(), data.tobytes())
        for column, v in zip(out, made, strict=True):
            column.append(v)
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=[f.split()[0] for f in DEALT.split(", ")])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of places for each document. A partition holds one deal, or several in a row: a deal is held until it is complete."""

    def close(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        ids, keys, place = (np.concatenate([h[n] for h in held]) for n in (0, 1, 2))
        order = np.lexsort((place, keys, ids))
        ids, keys, place = ids[order], keys[order], place[order]
        new = (np.diff(ids, prepend=ids[0] - 1) != 0) | (np.diff(keys, prepend=0) != 0)
        new[0] = True
        first, data, offsets = _by_document(np.cumsum(new), place)
        places = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(keys[first]), places], names=["doc_id", "key", "places"])

    held, now = [], None
    for batch in batches:
        for i in range(batch.num_rows):
            if (nth := batch.column(0)[i].as_py()) != now:
                yield from close(held)
                held, now = [], nth
            ids, keys, row, place = _opened(batch, i, 1)
            held.append((ids[row], keys[row], place))
    yield from close(held)


def _opened(batch: pa.RecordBatch, i: int, at: int):
    """ids and keys of a packed row's documents, and the document and place of each entry; columns from `at` on."""
    kinds = (np.int64, np.int64, np.uint8, np.uint8)
    raw = [np.frombuffer(batch.column(at + c)[i].as_buffer(), t) for c, t in enumerate(kinds)]
    counts, steps = unpack(raw[2])[0], unpack(raw[3])[0]
    first = np.cumsum(counts) - counts
    return raw[0], raw[1], np.repeat(np.arange(len(counts)), counts), _sums(steps, first)


def _finder(deals: int):
    """Places of windows that also start in an earlier document, dealt by document."""

    def bucket(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        base = np.cumsum([0] + [len(h[1]) for h in held])
        ids, keys = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        row = np.concatenate([h[3] + b for h, b in zip(held, base.tolist(), strict=False)])
        hashes, place = (np.concatenate([h[n] for h in held]) for n in (0, 4))
        held.clear()  # from here on the windows are held once
        later = np.flatnonzero(_smallest(hashes, ids[row]))
        del hashes
        if len(later):
            yield _dealt(deals, ids, keys, row[later], place[later])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None  # a partition holds one bucket, or several in a row: a bucket is held until it is complete
        for batch in batches:
            for i in range(batch.num_rows):
                nth = batch.column(0)[i].as_py()
                if nth != now:
                    yield from bucket(held)
                    held, now = [], nth
                ids, keys, row, place = _opened(batch, i, 2)
                if batch.column(1)[i].is_valid:
                    # Copies: the batch's memory goes back to its owner.
                    hashes = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint64).copy()
                    held.append((hashes, ids.copy(), keys.copy(), row.astype(np.int32), place.astype(np.int32)))
                elif len(row):
                    yield _dealt(deals, ids, keys, row, place)
        yield from bucket(held)

    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as small as they get before they cross the shuffle."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        small = [None if t is None else press.compress(t.encode()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(small, pa.binary())], names=["doc_id", "key", "small"])


def _cutter(k: int):
    def compute(small: pa.Array, marks: pa.Array) -> list[list]:
        press = zstandard.ZstdDecompressor()
        found = words(pa.array([None if s is None else press.decompress(s) for s in small.to_pylist()], pa.binary()).cast(pa.string()))
        edge = np.zeros(len(found.starts) + 1, np.int64)
        own = np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False))
        if len(own):
            flat = marks.drop_null()  # the packed places of all documents of this chunk
            offsets = np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1, flat.offset * 4)
            data = np.frombuffer(flat.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            steps, at = unpack(data)
            first = np.searchsorted(at, offsets[:-1] - offsets[0])
            start = _sums(steps, first) + np.repeat(found.bounds[own], np.diff(np.append(first, len(steps))))
            np.add.at(edge, start, 1)
            np.add.at(edge, start + k, -1)
        gone = np.cumsum(edge)[:-1] > 0
        cuts: list[list[dict]] = [[] for _ in range(len(small))]
        for i in own.tolist():
            turn = np.flatnonzero(np.diff(np.concatenate(([0], gone[found.bounds[i] : found.bounds[i + 1]].astype(np.int8), [0]))))
            cuts[i] = [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()]
        return [found.counts.tolist(), cuts, found.kept_texts(~gone)]

    return compute


def cut_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, cuts (maximal intervals of removed words, end exclusive), kept (the words
    that stay, joined by one blank).

    A window counts as repeated if its words also start somewhere in a row of smaller doc_id; rows of one doc_id never
    cut each other, so repeated rows come out alike. A missing doc_id is later than all others (and ties with the
    greatest long). Null and empty texts, and those of fewer than `k` words, keep all their words. An empty table gives
    an empty result; other columns are not looked at. Equal 64-bit hashes are taken for equal windows, and for
    equal texts of one doc_id or of none.
    """
    spark = docs.sparkSession
    reach_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    buckets = int(max(-(-size // BUCKET_BYTES), spark.sparkContext.defaultParallelism))
    # A bucket is a partition by its number, so its rows need no sort, which would hold them in the executor's heap.
    dealt = rows.mapInArrow(_emitter(k, buckets), PACKED).repartitionById(buckets, "bucket")
    # A document's places come from all buckets; they travel packed, and meet as one row.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = dealt.mapInArrow(_finder(width), DEALT).repartitionById(width, "deal")
    marks = found.mapInArrow(_gather, MARKS).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("places").alias("marks"))
    small = rows.mapInArrow(_squeeze, "doc_id long, key long, small binary")
    same = (F.coalesce("doc_id", F.lit(int(LAST))) == F.col("_id")) & (F.col("key") == F.col("_key"))
    # As many tasks as buckets: more would write files too small to be worth their cost, whatever the shuffle's width.
    joined = small.join(marks, same, "left").select("doc_id", "small", "marks").coalesce(buckets)
    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    fields = [StructField("n_words", LongType(), False), StructField("cuts", ArrayType(span), False), StructField("kept", StringType(), False)]
    return add_columns(joined, "small", fields, _cutter(k), ("marks",)).drop("small", "marks")


def repeats_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, the digest of the kept words."""
    found = cut_repeats(docs.select("doc_id", "text"))
    n_removed = F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + c["end"] - c["start"])
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))

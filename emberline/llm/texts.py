"""Arrow batches of texts: bounded chunks, words as byte spans, and Rabin-Karp hashes of words and word windows.

Both word rules are byte rules: bytes of a multi-byte UTF-8 character are word bytes, so words are found and
hashed on the UTF-8 buffer for a whole chunk of texts at once.
"""

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

# Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
#: Words are runs of everything but blank, tab, line feed, vertical tab, form feed and carriage return.
BLANK_WORDS = ~np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
#: Words are runs of digits, lower-case ASCII letters (after folding) and everything beyond ASCII.
PLAIN_WORDS = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_FOLD = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE_BYTE = np.uint64(0x9E3779B97F4A7C15)
_BASE_WORD = np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every other one."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (the base is odd, so it has an inverse)."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        steps = (np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))) for b in (base, inverse))
        with np.errstate(over="ignore"):
            known = tuple(np.cumprod(s, dtype=np.uint64) for s in steps)
        if size <= 2 * CHUNK_BYTES:
            _POWERS[int(base)] = known
    return known[0][:n], known[1][:n]


@dataclass
class Words:
    """Words of a chunk of texts: `data[start:end]` is a word; text i has the words `bounds[i]:bounds[i + 1]`, and
    its bytes begin at `offsets[i]`. At least one byte that is no word's follows each word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return mix(_spans(_BYTE_VALUE[self.data], self.starts, self.ends, _BASE_BYTE))

    def window_hashes(self, k: int, hashes: np.ndarray | None = None) -> np.ndarray:
        """Rabin-Karp hash of the k words from each position on; windows may run into the next text."""
        h = self.hashes() if hashes is None else hashes
        at = np.arange(max(0, len(h) - k + 1))
        return mix(_spans(h, at, at + k, _BASE_WORD))

    def inside(self, k: int) -> np.ndarray:
        """Positions at which a window of k words lies within one text, in text order."""
        n = np.maximum(self.counts - k + 1, 0)
        return np.repeat(self.bounds[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """Text that each word position belongs to."""
        return np.searchsorted(self.bounds, at, side="right") - 1

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def joined(self, lo: int, hi: int, keep: np.ndarray | None = None) -> bytes:
        """Words lo to hi joined by one blank; `keep` marks those to take."""
        at = np.arange(lo, hi) if keep is None else lo + np.flatnonzero(keep)
        if not len(at):
            return b""
        starts, lengths = self.starts[at], (self.ends - self.starts)[at] + 1
        out_ends = np.cumsum(lengths)
        source = np.repeat(starts - (out_ends - lengths), lengths) + np.arange(out_ends[-1])
        out = self.data[np.minimum(source, len(self.data) - 1)]
        out[out_ends - 1] = 0x20
        return out[:-1].tobytes()

    def kept_texts(self, keep: np.ndarray) -> pa.Array:
        """The marked words of each text, joined by one blank."""
        at = np.flatnonzero(keep)
        starts, stops = self.starts[at], self.ends[at] + 1
        # The last word of a text goes without the blank that follows the others.
        text = self.text_of(at)
        last = np.ones(len(at), bool)
        last[:-1] = text[1:] != text[:-1]
        data = self.data.copy()
        data[stops - 1] = 0x20
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts] += 1
        edge[stops - last] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        offsets = np.concatenate(([0], np.cumsum(inside)))[self.offsets].astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(self.bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hash of values[start:end], from one running sum."""
    power, inverse = _powers(base, len(values))
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * power, dtype=np.uint64)))
        return (total[ends] - total[starts]) * inverse[np.minimum(starts, max(0, len(values) - 1))]


def words(texts: pa.Array, rule: np.ndarray = BLANK_WORDS, fold: bool = False) -> Words:
    """Words of the texts; null has none. `fold` lower-cases A-Z first."""
    large = pa.large_string()
    empty, blank = pa.scalar("", large), pa.scalar(" ", large)
    # A blank after each text keeps the last word of one from running into the first of the next.
    closed = pc.binary_join_element_wise(pc.fill_null(texts.cast(large), empty), empty, blank)
    offsets = np.frombuffer(closed.buffers()[1], np.int64, len(closed) + 1, closed.offset * 8)
    data = np.frombuffer(closed.buffers()[2], np.uint8, offsets[-1]) if len(closed) else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] :], offsets - offsets[0]
    if fold:
        data = _FOLD[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[1:] = rule[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices with about `limit` bytes of text each, and the row that each begins at."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)) if len(texts) else []
    total = np.cumsum(sizes)
    at = 0
    while at < len(texts):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


#: Python workers outlive their tasks: arrays of this size and beyond, Arrow's included, go back to the system at once.
GIVE_BACK = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "4194304", "MALLOC_ARENA_MAX": "1", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def reach_package(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where the driver has it, and keep no freed memory.

    The path matters where the package is on the driver's path alone; installed on all nodes, it is found anyway.
    Settings that the session has already stay.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])
    for name, value in GIVE_BACK.items():
        environment.setdefault(name, value)


class Known:
    """A sorted set of hashes for lookups in bulk: a table of flags by low bits first, then a binary search."""

    def __init__(self, keys: np.ndarray, bits: int = 22):
        self.keys = np.unique(keys.astype(np.uint64))
        self.low = np.uint64((1 << bits) - 1)
        self.flags = np.zeros(1 << bits, bool)
        self.flags[(self.keys & self.low).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `hashes` that hold a known one, and the number of each in `keys`."""
        at = np.flatnonzero(self.flags[(hashes & self.low).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        nth = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        real = self.keys[nth] == hashes[at]
        return at[real], nth[real]


def add_columns(
    df: DataFrame,
    column: str,
    fields: list[StructField],
    compute: Callable[..., list],
    also: tuple[str, ...] = (),
) -> DataFrame:
    """`df` with new columns that `compute` makes from chunks of a text column and of the columns `also`; no shuffle.

    A column of `df` that has the name of a new one is replaced.
    """
    reach_package(df.sparkSession)
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = StructType([*kept, *fields])
    positions = [i for i, f in enumerate(df.schema.fields) if f.name not in names]
    source, others = df.columns.index(column), [df.columns.index(c) for c in also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            for at, texts in chunks(batch.column(source)):
                part = batch.slice(at, len(texts))
                made = compute(texts, *[part.column(i) for i in others])
                made = [v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in positions] + made, names=[f.name for f in schema.fields]
                )

    return df.mapInArrow(run, schema)

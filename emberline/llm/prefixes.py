"""Conversation prefix trie from sorted sequences: LCPs of neighbours, and a sparse table for minima over ranges of them.

Conversations become arrays of turn hashes and are sorted by range, so a prefix is an interval of the order. A task
takes one range. Each (conversation, depth) is a candidate prefix: two binary searches over the sparse table of the
LCPs, independent of all other candidates, give the left and right end of its interval. What a node reports are sums,
counts and minima over its interval; no stack and no tree is built.

Intervals that touch an end of the range may go on in the next one. They leave the task as partial sums, at most two
paths a range, and are added by the hash of their prefix. What two ranges count twice lies on the path that the last
sequence of one shares with the first of the other, and is taken off by one row for each node of that path. A hot
conversation or prefix thus spans many ranges and tasks. Texts are read in the scan only: a turn travels as its hash
and its number of code points.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emberline.llm.texts import mix, reach_package
from emberline.session import stage

#: Turns of rebuilt conversations that a range holds, about.
RANGE = 500_000
SHARED, FAMILY = 6, 100
_STEP = np.uint64(0xD1B54A32D192ED03)
ROOT = 0
NOTHING = hashlib.sha256(b"").hexdigest()

_FIELDS = {
    "part": ("int", pa.int32()),
    "kind": ("string", pa.string()),
    "key": ("long", pa.int64()),
    "parent_key": ("long", pa.int64()),
    "parent_open": ("boolean", pa.bool_()),
    "conv_id": ("long", pa.int64()),
    "parent_conv_id": ("long", pa.int64()),
    "depth": ("long", pa.int64()),
    "n_convs": ("long", pa.int64()),
    "n_children": ("long", pa.int64()),
    "n_leaves": ("long", pa.int64()),
    "saved_tokens": ("long", pa.int64()),
    "ends_sha256": ("string", pa.string()),
    "ends": ("binary", pa.binary()),
    "first_keys": ("array<long>", pa.list_(pa.int64())),
    "last_keys": ("array<long>", pa.list_(pa.int64())),
    "last_sums": ("array<long>", pa.list_(pa.int64())),
}
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the turns of each conversation in order, as (chars, hash).

    Turns go by `turn`, null first; rows of one turn number by the code points of their text, then by hash. Null roles
    and texts are empty. Rows without a conv_id belong to no conversation. A conversation's turns meet in one task, at
    some 30 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.length(text).cast("long").alias("chars"), F.xxhash64(role, text).alias("hash"),
    )
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    turns = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["chars"].alias("chars"), t["hash"].alias("hash")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def branched(conversations: DataFrame) -> DataFrame:
    """`sequences`, each rebuilt: the first h turns of the first conversation of its hundred, then its own after h.

    h is the CRC-32 of the decimal conv_id modulo 6. A first conversation that is absent gives no turns; one that has
    fewer gives all. A rebuilt conversation may have no turn. The remainder of a negative conv_id is negative, as in SQL.
    """
    own = stage(sequences(conversations), "trie-own")
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, SHARED - 1).alias("_head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    rows = own.withColumns({"_first": F.col("conv_id") - F.col("conv_id") % FAMILY, "_h": h}).join(heads, "_first", "left")
    none = F.expr("cast(array() AS array<struct<chars:bigint,hash:bigint>>)")
    head = F.when(F.col("_head").isNull(), none).otherwise(F.slice("_head", F.lit(1), F.col("_h")))
    tail = F.when(F.size("turns") <= F.col("_h"), none).otherwise(F.slice("turns", F.col("_h") + 1, F.size("turns")))
    return rows.select("conv_id", F.concat(head, tail).alias("turns"))


def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minimum of the 2**k values from each place on."""
    out = [values]
    while 2 << (len(out) - 1) <= len(values):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def minima(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo : hi + 1], for all pairs at once; lo <= hi."""
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    out = np.empty(len(lo), table[0].dtype)
    for k in np.unique(level).tolist():
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][lo[at]], table[k][hi[at] - (1 << k) + 1])
    return out


def extents(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row whose sequence begins with the first `depth` turns of `row`; table[0][i] is the LCP of the
    rows i - 1 and i. A jump of 2**k rows is taken if no LCP on its way is below the depth."""
    n = len(table[0])
    left, right = row.copy(), row.copy()
    for k in range(len(table) - 1, -1, -1):
        span, level = 1 << k, table[k]
        at = np.flatnonzero(right + span < n)
        at = at[level[right[at] + 1] >= depth[at]]
        right[at] += span
        at = np.flatnonzero(left >= span)
        at = at[level[left[at] - span + 1] >= depth[at]]
        left[at] -= span
    return left, right


def _repeat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), and so on."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _keys(hashes: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of the prefix that ends with each turn: a polynomial over the turns of its row, and the depth."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(place.max(initial=0)), _STEP))), dtype=np.uint64)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes) * power[place], dtype=np.uint64)))
        lead = np.repeat(total[bounds[:-1]], np.diff(bounds))
        return mix(total[1:] - lead + mix(place.astype(np.uint64) + np.uint64(1))).view(np.int64)


def range_nodes(part: int, convs: np.ndarray, hashes: np.ndarray, chars: np.ndarray, bounds: np.ndarray) -> Iterator[dict]:
    """Columns of the nodes of one range. Sequence i has the turns bounds[i]:bounds[i + 1]; sequences are sorted by
    their hashes, equal ones by conv_id."""
    counts = np.diff(bounds)
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
    keys = _keys(hashes.view(np.uint64), place, bounds)
    # LCP with the sequence before: the places where both have the same prefix key.
    both = np.minimum(counts[1:], counts[:-1])
    same = keys[_repeat(bounds[:-2], both)] == keys[_repeat(bounds[1:-1], both)]
    run = np.concatenate(([0], np.cumsum(same)))
    edge = np.concatenate(([0], np.cumsum(both)))
    lcp = np.concatenate(([-1], run[edge[1:]] - run[edge[:-1]]))
    # Equal sequences are one row from here on.
    first = np.flatnonzero(np.concatenate(([True], (lcp[1:] < counts[1:]) | (counts[1:] != counts[:-1]))))
    many = np.diff(np.append(first, len(convs)))
    lcp, length, low = lcp[first], counts[first], bounds[first]
    n = len(first)
    sums = np.concatenate(([0], np.cumsum(chars)))
    until = lambda row, depth: sums[low[row] + depth] - sums[low[row]]  # noqa: E731  code points of the first turns
    whole = until(np.arange(n), length)
    leaf = np.concatenate((lcp[1:] < length[:-1], [True]))
    members, leaves = (np.concatenate(([0], np.cumsum(v))) for v in (many, leaf))
    weighted = np.concatenate(([0], np.cumsum(many * whole)))
    added = np.concatenate(([0], np.cumsum(whole - until(np.arange(n), np.maximum(lcp, 0)))))
    by_lcp = np.sort(lcp * np.int64(n) + np.arange(n))
    # All candidates: every row at every depth, the root among them.
    row = np.repeat(np.arange(n), length + 1)
    depth = _repeat(np.zeros(n, np.int64), length + 1)
    left, right = extents(sparse(lcp), row, depth)
    ids = sparse(convs[first])
    own = np.flatnonzero(left == row)
    row, depth, last = row[own], depth[own], right[own]
    by_end = np.concatenate(([ROOT], keys))
    key = np.where(depth > 0, by_end[low[row] + depth], ROOT)
    above = np.maximum(own - 1, 0)  # the candidate of the same row, one turn shorter
    parent_key = np.where(depth > 1, by_end[low[row] + depth - 1], ROOT)
    open_ = (row == 0) | (last == n - 1)
    n_convs = members[last + 1] - members[row]
    before = until(row, np.maximum(depth - 1, 0))
    saved = weighted[last + 1] - weighted[row] - n_convs * before - (added[last + 1] - added[row + 1] + whole[row] - before)
    split = np.searchsorted(by_lcp, depth * n + last, "right") - np.searchsorted(by_lcp, depth * n + row, "right")
    ends = [None] * len(own)
    for i in np.flatnonzero(depth == length[row]).tolist():
        lo = first[row[i]]
        ends[i] = ",".join(map(str, convs[lo : lo + many[row[i]]].tolist())).encode()
    shut = [NOTHING if e is None else hashlib.sha256(e).hexdigest() for e in ends]
    flags = open_.tolist()
    yield {
        "part": np.full(len(own), part, np.int32),
        "kind": ["part" if o else "node" for o in flags],
        "key": key,
        "parent_key": pa.array(parent_key, mask=depth == 0),
        "parent_open": (left[above] == 0) | (right[above] == n - 1),
        "conv_id": minima(ids, row, last),
        "parent_conv_id": pa.array(minima(ids, left[above], right[above]), mask=depth == 0),
        "depth": depth,
        "n_convs": n_convs,
        "n_children": split + (length[row] > depth),
        "n_leaves": leaves[last + 1] - leaves[row],
        "saved_tokens": saved,
        "ends_sha256": [None if o else s for o, s in zip(flags, shut, strict=True)],
        "ends": [e if o else None for o, e in zip(flags, ends, strict=True)],
    }
    final = slice(low[-1], low[-1] + length[-1])
    yield {
        "part": [part], "kind": ["edge"], "first_keys": [keys[low[0] : low[0] + length[0]].tolist()],
        "last_keys": [keys[final].tolist()], "last_sums": [(sums[low[-1] : low[-1] + length[-1] + 1] - sums[low[-1]]).tolist()],
    }


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = pa.Table.from_batches(parts) if (parts := list(batches)) else None
    if held is None or not held.num_rows:
        return
    convs, hashes, chars = (held.column(c).combine_chunks() for c in range(3))
    bounds = np.concatenate(([0], np.cumsum(hashes.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    flat = [a.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for a in (hashes, chars)]
    for made in range_nodes(TaskContext.get().partitionId(), convs.to_numpy(), *flat, bounds):
        n = len(made["part"])
        columns = [made.get(name) for name in _FIELDS]
        arrays = [
            c.cast(kind) if isinstance(c, pa.Array) else pa.nulls(n, kind) if c is None else pa.array(c, kind)
            for c, (_, kind) in zip(columns, _FIELDS.values(), strict=True)
        ]
        whole = pa.RecordBatch.from_arrays(arrays, names=list(_FIELDS))
        for lo in range(0, n, 50_000):
            yield whole.slice(lo, 50_000)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from its pieces; rows (key, part, ends) come sorted by key and part, a piece is held at a time."""
    now, state = None, None
    for batch in batches:
        keys, out = [], []
        for key, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if key == now:
                state.update(b",")
            else:
                if state is not None:
                    keys.append(now)
                    out.append(state.hexdigest())
                now, state = key, hashlib.sha256()
            state.update(ends)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.string())], names=["key", "digest"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], names=["key", "digest"])


def _twice(edges: DataFrame) -> DataFrame:
    """What neighbouring ranges count twice, as negative parts: key, depth and the sums to add."""
    order = W.orderBy("part")  # one row a range
    pairs = edges.select("first_keys", *[F.lag(c).over(order).alias(c) for c in ("last_keys", "last_sums")]).filter("last_keys IS NOT NULL")
    shared = F.size(F.filter(F.zip_with("first_keys", "last_keys", lambda a, b: a == b), lambda x: x))
    path = pairs.withColumn("shared", shared).withColumn("depth", F.explode(F.sequence(F.lit(0), F.col("shared"))))
    whole = F.size("last_keys") == F.col("shared")
    return path.select(
        F.expr(f"if(depth = 0, {ROOT}L, get(last_keys, depth - 1))").alias("key"),
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") < F.col("shared"), -1).otherwise(0).cast("long").alias("n_children"),
        F.when(whole, -1).otherwise(0).cast("long").alias("n_leaves"),
        F.expr("get(last_sums, shared) - get(last_sums, greatest(depth - 1, 0))").alias("saved_tokens"),
    )


def prefix_trie(rebuilt: DataFrame, turns: int = RANGE) -> DataFrame:
    """Per distinct prefix of the sequences (conv_id, turns): conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A sequence without turns is a member of the root and ends there; the root has no parent. The ends are the conv_ids
    of the sequences that are the prefix as a whole, in numerical order. Repeated rows are members each. An empty table
    has no node. `turns` is the size of a range. Equal 64-bit hashes are taken for equal turns and prefixes.
    """
    spark = rebuilt.sparkSession
    reach_package(spark)
    rows = rebuilt.select("conv_id", F.transform("turns", lambda t: t["hash"]).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"))
    rows = stage(rows, "trie-rows")
    size = rows.agg(F.sum(F.size("path").cast("long") + 1).alias("n")).first()["n"] or 0
    parts = max(-(-size // turns), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in _FIELDS.items())
    nodes = stage(ordered.select("conv_id", "path", "chars").mapInArrow(_ranges, schema), "trie-nodes")
    open_ = nodes.filter("kind = 'part'")
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts_ = open_.select("key", "depth", *numbers, "conv_id", "parent_key")
    summed = parts_.unionByName(_twice(nodes.filter("kind = 'edge'")), allowMissingColumns=True).groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), *[F.sum(c).alias(c) for c in numbers]
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = open_.filter("ends IS NOT NULL").select("key", "part", "ends").repartition(width, "key").sortWithinPartitions("key", "part")
    digests = ends.mapInArrow(_digests, "key long, digest string")
    whole = stage(
        summed.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(NOTHING))).drop("digest"), "trie-open"
    )
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    spanning = whole.join(above, "parent_key", "left").select(*RESULT)
    inner = nodes.filter("kind = 'node'")
    # Children of an open node are many where it is hot: it goes to each range that it touches, under that range's name.
    local = open_.select("part", "key").join(whole.select("key", "conv_id"), "key").select(
        "part", F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent")
    )
    hung = inner.filter("parent_open").drop("parent_conv_id").join(local, ["part", "parent_key"]).withColumnRenamed("_parent", "parent_conv_id")
    return inner.filter("NOT parent_open").select(*RESULT).unionByName(hung.select(*RESULT)).unionByName(spanning)

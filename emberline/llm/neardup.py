"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Two sets link if they share a set part of their union. The sizes then bound the n-grams in which they differ, K. The columns
of the matrix are cut into more than K blocks by hash, so linked rows agree in whole column blocks: a row's content in
a block is one hash, and rows that agree nowhere are discarded before any product. Rows that agree by a shared passage
alone are told apart by parities: every n-gram flips one of the row's bits, which are as many as its n-grams, so linked
rows differ in K bits at most. What passes both forms clusters, which are cut into row blocks of a set size. The product of two row blocks is
taken over their shared columns, overlaps add up, and pairs below the bound of their sizes are dropped. What is left
are the links.

Rows of equal sets are one row from the start. Links leave a task as stars of their components, never as pairs. A cluster
of many blocks is first multiplied with one of them; what that joins into one component needs no product within itself.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField

from emberline.llm.graph import array_components, components
from emberline.llm.repeats import pack, unpack
from emberline.llm.texts import Words, add_columns, chunks, mix, reach_package, words
from emberline.session import stage


@dataclass(frozen=True)
class Rule:
    """Sets hold shingles of so many words, and link if whole * overlap >= part * union."""

    shingle: int = 4
    part: int = 85
    whole: int = 100


#: The rule of op 9.
RULE = Rule()
#: Signatures that a task folds at once and that a bucket holds, and n-grams (1,000 a row at least) of a row block.
FOLD, BUCKET, BLOCK = 600_000, 800_000, 1_000_000
#: A bucket per so many bytes of text, at six bytes an n-gram and a signature for every third.
BUCKET_BYTES = 18 * BUCKET
#: Columns with more rows than this in a row block are multiplied densely.
DENSE = 32
#: Words of parity bits that a row has at least and at most, and the rows that agree in a block up to which each is held
#: against each. More of them are one cluster at once, which the product then takes apart.
NARROW, WIDE, LIST = 8, 256, 20_000
#: Words of parities that are compared at once.
COMPARED = 1 << 18


def linked(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """The size-derived bound: the union is a + b - overlap."""
    return (rule.part + rule.whole) * overlap >= rule.part * (a + b)


def reach(a: np.ndarray, b: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """K: the most n-grams in which linked sets of these sizes differ."""
    return (a + b) * (rule.whole - rule.part) // (rule.whole + rule.part)


@dataclass
class Parities:
    """Bits of sets, in words: set i has `wide[i]` of them (a power of two) from `first[i]` on. An n-gram flips one."""

    flat: np.ndarray
    first: np.ndarray
    wide: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray, bounds: np.ndarray) -> "Parities":
        """Between one and two bits an n-gram, within the bounds."""
        size = np.diff(bounds)
        wide = np.clip(1 << np.ceil(np.log2(np.maximum(size, 1) / 64)).clip(0).astype(np.int64), NARROW, WIDE)
        first = np.cumsum(wide) - wide
        owner = np.repeat(np.arange(len(size)), size)
        cell = mix(grams ^ np.uint64(0x2545F4914F6CDD1D)) & (64 * wide[owner] - 1).astype(np.uint64)
        flat = np.zeros(int(wide.sum()), np.uint64)
        np.bitwise_xor.at(flat, first[owner] + (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63)))
        return cls(flat, first, wide)

    @classmethod
    def joined(cls, parts: list["Parities"]) -> "Parities":
        base = np.cumsum([0] + [len(p.flat) for p in parts])
        first = np.concatenate([p.first + b for p, b in zip(parts, base, strict=False)])
        return cls(np.concatenate([p.flat for p in parts]), first, np.concatenate([p.wide for p in parts]))

    @classmethod
    def read(cls, rows: list[bytes]) -> "Parities":
        wide = np.array([len(r) // 8 for r in rows], np.int64)
        return cls(np.frombuffer(b"".join(rows), np.uint64), np.cumsum(wide) - wide, wide)

    def row(self, i: int) -> bytes:
        return self.flat[self.first[i] : self.first[i] + self.wide[i]].tobytes()

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """The sets `at` in `width` words: the bits of a wider one fold onto those of the same place modulo the width."""
        place = self.first[at][:, None] + np.arange(width)
        out = self.flat[place]
        wide = self.wide[at]
        for part in range(1, int(wide.max(initial=width)) // width):
            more = np.flatnonzero(wide > part * width)
            out[more] ^= self.flat[place[more] + part * width]
        return out

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which the sets x[i] and y[i] differ, in the narrower one's width: no more than n-grams in which they do."""
        width = np.minimum(self.wide[x], self.wide[y])
        out = np.zeros(len(x), np.int64)
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            for lo in range(0, len(at), max(1, COMPARED // w)):
                cut = at[lo : lo + max(1, COMPARED // w)]
                out[cut] = np.bitwise_count(self.rows(x[cut], w) ^ self.rows(y[cut], w)).sum(1, dtype=np.int64)
        return out


@lru_cache(maxsize=8)
def levels(rule: Rule = RULE, most: int = 1 << 40) -> np.ndarray:
    """First sizes of levels such that linked sets lie in one level or in two that touch."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * rule.whole // rule.part + 1)
    return np.array(out, np.int64)


def blocks_of(level: np.ndarray, rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """K, the most n-grams in which linked sets differ whose smaller one is of this level, and the column blocks.

    One block more than K must be equal in both. As equal blocks may be empty in both, `spare` blocks come on top: a
    set with no more empty blocks than that has an equal block that is not empty.
    """
    small = levels(rule)[level + 1] - 1
    differ = (small + small * rule.whole // rule.part) * (rule.whole - rule.part) // (rule.whole + rule.part)
    spare = 1 + differ // 20
    return differ, differ + 1 + spare


def shingle_sets(found: Words, width: int = RULE.shingle) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all texts of a chunk, text by text in order of hash, and the bounds of each text."""
    hashes, n = found.hashes(), found.counts
    inside = found.inside(width)
    grams = found.window_hashes(width, hashes)[inside] if len(inside) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(n)), np.maximum(n - width + 1, 0))
    # A shorter text is one n-gram as a whole.
    short = np.flatnonzero((n > 0) & (n < width))
    whole = np.zeros(len(short), np.uint64)
    for size in range(1, width):
        at = np.flatnonzero(n[short] == size)
        if len(at):
            whole[at] = mix(found.window_hashes(size, hashes)[found.bounds[short[at]]] + np.uint64(size))
    grams, owner = np.concatenate((grams, whole)), np.concatenate((owner, short))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(n) + 1))


def set_names(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One long for each set, from the sum of its n-grams and its size; equal sets have equal names."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams + np.uint64(1)), dtype=np.uint64)))
    size = np.diff(bounds).astype(np.uint64)
    return mix(total[bounds[1:]] - total[bounds[:-1]] + mix(size + np.uint64(7))).view(np.int64)


def signatures(grams: np.ndarray, bounds: np.ndarray, rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the column blocks of each set, for its own level and the one below, and the set of each."""
    size = np.diff(bounds)
    rows = np.flatnonzero(size)
    own = np.searchsorted(levels(rule), size[rows], side="right") - 1
    out, sets = [], []
    spread = mix(grams ^ np.uint64(0x5BD1E995))
    value = mix(grams + np.uint64(3))
    for step in (0, 1):
        use = own >= step
        at, group = rows[use], own[use] - step
        differ, blocks = blocks_of(group, rule)
        first = np.concatenate(([0], np.cumsum(blocks)))
        count = size[at]
        gram = np.repeat(bounds[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        block = (spread[gram] % np.repeat(blocks, count).astype(np.uint64)).astype(np.int64)
        cell = np.repeat(first[:-1], count) + block
        content = np.zeros(first[-1], np.uint64)
        np.add.at(content, cell, value[gram])
        filled = np.bincount(cell, minlength=first[-1]) > 0
        owner = np.repeat(np.arange(len(at)), blocks)
        place = np.arange(first[-1]) - first[:-1][owner]
        label = mix(group[owner].astype(np.uint64) * np.uint64(1 << 40) + place.astype(np.uint64))
        out.append(mix(content + label)[filled])
        sets.append(at[owner[filled]])
        # Sets with too many empty blocks meet at a signature of their own.
        empty = blocks - np.bincount(owner[filled], minlength=len(at))
        odd = np.flatnonzero(empty > blocks - differ - 1)
        out.append(mix(mix(group[odd].astype(np.uint64) + np.uint64(11))))
        sets.append(at[odd])
    return np.concatenate(out), np.concatenate(sets)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges as hold the same nodes together."""
    nodes, roots = array_components(a, b)
    inner = nodes != roots
    return nodes[inner], roots[inner]


#: Signatures by bucket; each stands for its node and, within `slack` bits, for nodes of its task. Or an edge (a, b).
PACKED = "bucket int, signatures binary, nodes binary, counts binary, slacks binary, a long, b long"
_KINDS = [pa.int32(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
_NAMES = [f.split()[0] for f in PACKED.split(", ")]


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)


def fold(key: np.ndarray, row: np.ndarray, node: np.ndarray, size: np.ndarray, parity: Parities, rule: Rule):
    """Entries (key, row) that must travel, their slack, and edges for the rest.

    Of the rows of one task with the same signature the one of least node speaks for those close to it: they are tied to
    it by an edge. Its slack keeps every node that one of them may be linked with within reach of it, by the triangle
    inequality, in bits and in size.
    """
    order = np.lexsort((node[row], key))
    key, row = key[order], row[order]
    # Copies of one set in one task are one entry.
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[row[1:]] != node[row[:-1]])
    key, row = key[new], row[new]
    first = _runs(key)
    centre = np.repeat(first, np.diff(np.append(first, len(key))))
    slack = np.zeros(len(key), np.int64)
    rest = np.flatnonzero(centre != np.arange(len(key)))
    mine, other = row[rest], row[centre[rest]]
    bits, shift = parity.apart(mine, other), np.abs(size[mine] - size[other])
    bound = reach(size[mine], size[other], rule)
    wide = np.maximum(bits, shift) + reach(shift, shift, rule) + 1
    close = (bits <= bound) & (shift <= bound) & (2 * wide <= bound)
    gone = rest[close]
    np.maximum.at(slack, centre[gone], wide[close])
    stay = np.ones(len(key), bool)
    stay[gone] = False
    return key[stay], row[stay], slack[stay], node[row[gone]], node[row[centre[gone]]]


def _emitter(buckets: int, rule: Rule):
    """Packed signatures by bucket, and edges between close sets of one task that share a signature."""

    def packed(keys: list, rows: list, sets: list) -> Iterator[pa.RecordBatch]:
        node, size = (np.concatenate([s[n] for s in sets]) for n in (0, 1))
        parity = Parities.joined([s[2] for s in sets])
        key, row, slack, a, b = fold(np.concatenate(keys), np.concatenate(rows), node, size, parity, rule)
        if len(a):
            a, b = _stars(a, b)
            none = pa.nulls(len(a), pa.binary())
            # Edges need no bucket of their own; they are dealt by their node.
            deal = pa.array((a.view(np.uint64) % np.uint64(buckets)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([deal, none, none, none, none, pa.array(a), pa.array(b)], names=_NAMES)
        node = node[row]
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((node, bucket))
        key, node, slack, bucket = key[order], node[order], slack[order], bucket[order]
        bounds = np.searchsorted(bucket, np.arange(buckets + 1))
        out: list[list] = [[] for _ in _NAMES]
        for nth in np.flatnonzero(np.diff(bounds)).tolist():
            own = slice(bounds[nth], bounds[nth + 1])
            first = _runs(node[own])
            counts = pack(np.diff(np.append(first, bounds[nth + 1] - bounds[nth])))[0]
            made = (nth, key[own].tobytes(), node[own][first].tobytes(), counts.tobytes(), pack(slack[own])[0].tobytes(), None, None)
            for column, v in zip(out, made, strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, _KINDS, strict=True)], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows, sets, held, many = [], [], [], 0, 0
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                grams, bounds = shingle_sets(words(texts, fold=True), rule.shingle)
                key, owner = signatures(grams, bounds, rule)
                keys.append(key)
                rows.append(owner + many)
                sets.append((set_names(grams, bounds), np.diff(bounds), Parities.of(grams, bounds)))
                many += len(texts)
                held += len(key)
                if held >= FOLD:
                    yield from packed(keys, rows, sets)
                    keys, rows, sets, held, many = [], [], [], 0, 0
        if held:
            yield from packed(keys, rows, sets)

    return run


#: Nodes that share a signature, under a name that equal lists have in common. Or an edge.
LISTS = "list long, nodes binary, slacks binary, a long, b long"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of nodes that share a signature, equal ones once; rows come sorted by bucket, and a bucket is held until
    complete. A list that is too long to be held against itself is tied together as it is."""
    names = [f.split()[0] for f in LISTS.split(", ")]

    def edges(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(a), pa.array(b)], names=names)

    def close(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, node, slack = (np.concatenate(p) for p in zip(*held, strict=True))
        order = np.lexsort((-slack, node, key))
        key, node, slack = key[order], node[order], slack[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])  # of one node the entry of most slack
        key, node, slack = key[new], node[new], slack[new]
        first = _runs(key)
        many = np.diff(np.append(first, len(key)))
        each = mix(node.view(np.uint64) + mix(slack.astype(np.uint64) + np.uint64(5)))
        name = mix(np.add.reduceat(each, first) + many.astype(np.uint64)).view(np.int64)
        long = np.flatnonzero(many > LIST)
        for lo, n in zip(first[long].tolist(), many[long].tolist(), strict=True):
            yield from edges(node[lo + 1 : lo + n], np.full(n - 1, node[lo]))
        short = np.flatnonzero((many > 1) & (many <= LIST))
        name, nth = np.unique(name[short], return_index=True)
        out: list[list] = [[], [], []]
        for label, g in zip(name.tolist(), short[nth].tolist(), strict=True):
            own = slice(first[g], first[g] + many[g])
            for column, v in zip(out, (label, node[own].tobytes(), pack(slack[own])[0].tobytes()), strict=True):
                column.append(v)
        if len(name):
            none = pa.nulls(len(name), pa.int64())
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(out, kinds, strict=True)), none, none], names=names)

    held, now = [], None
    for batch in batches:
        known = batch.column(5).is_valid().to_numpy(zero_copy_only=False)
        if known.any():
            part = batch.filter(pa.array(known))
            yield from edges(part.column(5).to_numpy(), part.column(6).to_numpy())
        for i in np.flatnonzero(~known).tolist():
            nth = batch.column(0)[i].as_py()
            if nth != now:
                yield from close(held)
                held, now = [], nth
            kinds = ((1, np.uint64), (2, np.int64), (3, np.uint8), (4, np.uint8))
            key, node, counts, slacks = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in kinds)
            held.append((key.copy(), np.repeat(node, unpack(counts)[0]), unpack(slacks)[0]))
    yield from close(held)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists to their rows (list, node, slack)."""
    for batch in batches:
        for label, nodes, slacks in zip(*(batch.column(c) for c in range(3)), strict=True):
            node = np.frombuffer(nodes.as_buffer(), np.int64)
            slack = unpack(np.frombuffer(slacks.as_buffer(), np.uint8))[0]
            columns = [pa.array(np.full(len(node), label.as_py(), np.int64)), pa.array(node), pa.array(slack.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["list", "node", "slack"])


def tied(own: np.ndarray, node: np.ndarray, size: np.ndarray, parity: Parities, slack: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Edges that hold together those of the sets `own` that may be linked, directly or over others: a search from set to
    set, each against those not reached yet."""
    left, a, b = own, [], []
    while len(left) > 1:
        ahead, left = [left[0]], left[1:]
        while ahead and len(left):
            at = ahead.pop()
            bound = reach(size[left], size[at], rule) + slack[left] + slack[at]
            # The cheap test first.
            near = np.flatnonzero(np.abs(size[left] - size[at]) <= bound)
            near = near[parity.apart(left[near], np.full(len(near), at)) <= bound[near]]
            if len(near):
                found = left[near]
                a.append(node[found])
                b.append(np.full(len(found), node[at]))
                ahead += found.tolist()
                stay = np.ones(len(left), bool)
                stay[near] = False
                left = left[stay]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _tier(rule: Rule):
    """Edges of each list. Rows (list, node, n, parity, slack) come sorted by list."""

    def close(lists, node, size, rows, slack) -> Iterator[pa.RecordBatch]:
        parity = Parities.read(rows.tolist())
        first = _runs(lists)
        many = np.diff(np.append(first, len(lists)))
        # Lists of two at once, the others one by one.
        two = first[many == 2]
        bound = reach(size[two], size[two + 1], rule) + slack[two] + slack[two + 1]
        near = (np.abs(size[two] - size[two + 1]) <= bound) & (parity.apart(two, two + 1) <= bound)
        a, b = [node[two[near]]], [node[two[near] + 1]]
        for lo, n in zip(first[many > 2].tolist(), many[many > 2].tolist(), strict=True):
            x, y = tied(np.arange(lo, lo + n), node, size, parity, slack, rule)
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            a, b = _stars(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        many = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, node, size, slack = (batch.column(c).to_numpy() for c in (0, 1, 2, 4))
            rows = batch.column(3).to_numpy(zero_copy_only=False)  # bytes
            held.append([lists, node, size, rows, slack.astype(np.int64)])
            many += batch.column(3).nbytes
            if many >= 8 * COMPARED:
                whole = [np.concatenate(c) for c in zip(*held, strict=True)]
                cut = _runs(whole[0])[-1]  # the last list may go on
                yield from close(*[c[:cut] for c in whole])
                held, many = [[c[cut:] for c in whole]], 0
        if held:
            yield from close(*[np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def block_links(grams: list[np.ndarray], rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs among the sets of a block, by the product of their incidence matrix with itself.

    Columns of one set add nothing. Sparse columns add one to each pair of their sets; dense ones are multiplied as
    matrices, some hundred at a time. Both add to the same overlaps.
    """
    n = len(grams)
    size = np.array([len(g) for g in grams], np.int64)
    token, owner = np.concatenate(grams), np.repeat(np.arange(n), size)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    many = np.diff(np.append(first, len(token)))
    overlap = np.zeros((n, n), np.int32)
    flat = overlap.reshape(-1)
    for count in np.unique(many[(many > 1) & (many <= DENSE)]).tolist():
        x, y = np.triu_indices(count, 1)
        starts = first[many == count]
        step = max(1, 2_000_000 // len(x))
        for lo in range(0, len(starts), step):
            rows = owner[starts[lo : lo + step, None] + np.arange(count)]
            cells = (rows[:, x] * n + rows[:, y]).ravel()
            if len(cells) * 8 > n * n:
                flat += np.bincount(cells, minlength=n * n).astype(np.int32)
            else:
                np.add.at(flat, cells, 1)
    dense = np.flatnonzero(many > DENSE)
    for lo in range(0, len(dense), 512):
        part = dense[lo : lo + 512]
        matrix = np.zeros((n, len(part)), np.float32)
        for column, d in enumerate(part.tolist()):
            matrix[owner[first[d] : first[d] + many[d]], column] = 1
        overlap += (matrix @ matrix.T).astype(np.int32)  # at most 512 each: exact
    # Owners are in order within a column, so sparse pairs lie above the diagonal; dense ones lie on both sides.
    upper = np.triu(np.ones((n, n), bool), 1)
    x, y = np.nonzero(upper & (overlap > 0))
    keep = linked(overlap[x, y].astype(np.int64), size[x], size[y], rule)
    return x[keep], y[keep]


def _multiplier(rule: Rule):
    """Links within each pair of row blocks, as stars. Rows (block, node, small) come sorted by block."""

    def close(nodes: list[int], small: list[bytes]) -> Iterator[pa.RecordBatch]:
        if len(nodes) < 2:
            return
        press = zstandard.ZstdDecompressor()
        grams, names = [], []
        for _, texts in chunks(pa.array([press.decompress(s) for s in small], pa.binary()).cast(pa.string())):
            made, bounds = shingle_sets(words(texts, fold=True), rule.shingle)
            grams += [made[lo:hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        names = np.array(nodes, np.int64)
        x, y = block_links(grams, rule)
        if len(x):
            a, b = _stars(names[x], names[y])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, small, now, last = [], [], None, None
        for batch in batches:
            for block, node, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if block != now:
                    yield from close(nodes, small)
                    nodes, small, now, last = [], [], block, None
                if node != last:  # repeated rows of one text
                    nodes.append(node)
                    small.append(text)
                last = node
        yield from close(nodes, small)

    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as small as they get before they cross the shuffle."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        small = [press.compress(t.encode()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(small, pa.binary())], names=["_id", "_key", "small"])


def _name(*columns: str) -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns]).alias("block")


def _blocked(members: DataFrame, name: str) -> DataFrame:
    """`members` (node, root, level, w) with parts and nth: each level of a cluster is cut by hash into `parts` blocks of
    about BLOCK n-grams."""
    sums = members.groupBy("root", "level").agg(F.ceil(F.sum("w") / BLOCK).cast("int").alias("parts"))
    return members.join(stage(sums, name), ["root", "level"]).withColumn("nth", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _first_units(members: DataFrame) -> DataFrame:
    """node, block: a cluster of up to BLOCK n-grams is one block. A larger one is cut into blocks by hash, and its first
    block goes to all of them, so every row is multiplied with that one. `members` are node, root, w."""
    parts = members.groupBy("root").agg(F.ceil(F.sum("w") / BLOCK).cast("int").alias("parts"))
    rows = members.join(stage(parts, "near-parts"), "root").withColumn("nth", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    places = F.expr("if(nth = 0, sequence(0, parts - 1), array(nth))")
    rows = rows.withColumn("place", F.explode(places))
    return rows.select("node", _name("root", "place"))


def _second_units(members: DataFrame) -> DataFrame:
    """node, block: the rows that the first product left outside of their cluster's largest component, against all rows.

    `members` are node, root, level, w, comp. Linked rows of one component need no product, so the largest one of a
    cluster is multiplied with the others only. A block meets those of its level and of the levels beside it.
    """
    weight = members.groupBy("root", "comp").agg(F.sum("w").alias("w"))
    largest = weight.groupBy("root").agg(F.max_by("comp", F.struct("w", "comp")).alias("_most"), F.count("*").alias("_comps"))
    rows = members.join(largest.filter("_comps > 1"), "root")
    rest = _blocked(rows.filter("comp != _most").select("node", "root", "level", "w"), "near-rest-parts")
    every = _blocked(rows.select("node", "root", "level", "w"), "near-all-parts")
    near = F.explode(F.expr("sequence(-1, 1)"))

    def beside(own: DataFrame, others: DataFrame) -> DataFrame:
        """Each row of `own` with every block of `others` in its level and beside it."""
        blocks = others.select("root", F.col("level").alias("_level"), F.col("parts").alias("_parts")).distinct()
        wide = own.withColumn("_step", near).withColumn("_level", F.col("level") + F.col("_step"))
        return wide.join(blocks, ["root", "_level"]).withColumn("_nth", F.explode(F.expr("sequence(0, _parts - 1)")))

    left = beside(rest, every).select("node", _name("root", "level", "nth", "_level", "_nth"))
    right = beside(every, rest).select("node", _name("root", "_level", "_nth", "level", "nth"))
    return left.unionByName(right)


def near_groups(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Per row of `docs`: doc_id, key (64-bit hash of the text), n_shingles, component_id (the least doc_id reachable by
    links, itself included), and group, which rows of one component share and which is null for an empty set.

    Words are runs without white space, A-Z lower-cased. A set holds the distinct shingles of `rule`, or the whole text if
    it has fewer words; a text that is null or has no word has an empty set and links with nothing. Rows without a
    doc_id have a null component_id unless they link with a row that has one.
    Repeated rows are linked with each other. An empty table gives an empty result; other columns are not looked at.
    Equal 64-bit hashes are taken for equal shingles, equal names for equal sets, and equal keys for equal
    texts of one doc_id or of none.
    """
    spark = docs.sparkSession
    reach_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def measure(texts: pa.Array) -> list[list]:
        grams, bounds = shingle_sets(words(texts, fold=True), rule.shingle)
        size = np.diff(bounds)
        level = (np.searchsorted(levels(rule), size, side="right") - 1).tolist()
        parity = Parities.of(grams, bounds)
        return [size.tolist(), set_names(grams, bounds).tolist(), level, [parity.row(i) for i in range(len(size))]]

    keyed = docs.withColumn("key", F.xxhash64("text"))
    fields = [
        StructField("n_shingles", LongType()), StructField("node", LongType()), StructField("level", IntegerType()), StructField("parity", BinaryType())
    ]
    rows = add_columns(keyed, "text", fields, measure).drop("text")
    rows = stage(rows, "near-rows")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    nodes = stage(
        rows.filter("n_shingles > 0").groupBy("node").agg(
            F.min(own).alias("rep"), F.first("n_shingles").alias("n"), F.first("level").alias("level"), F.first("parity").alias("parity")
        ),
        "near-nodes",
    )
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    buckets = int(max(-(-size // BUCKET_BYTES), spark.sparkContext.defaultParallelism))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("text").mapInArrow(_emitter(buckets, rule), PACKED).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    met = stage(dealt.mapInArrow(_meet, LISTS), "near-lists")
    lists = met.filter("list IS NOT NULL").select("list", "nodes", "slacks").dropDuplicates(["list"])
    entries = lists.mapInArrow(_members, "list long, node long, slack int").join(nodes.select("node", "n", "parity"), "node")
    entries = entries.select("list", "node", "n", "parity", "slack").repartition(width, "list").sortWithinPartitions("list")
    edges = met.filter("a IS NOT NULL").select("a", "b").unionByName(entries.mapInArrow(_tier(rule), "a long, b long"))
    clusters = components(edges, "near-clusters")
    weight = F.greatest(F.col("n"), F.lit(1000)).alias("w")
    members = stage(clusters.join(nodes, "node").select("node", "root", "level", weight, "rep"), "near-members")
    # The text of one row for each set in a cluster, small, then dealt to its row blocks.
    none = F.lit(int(np.iinfo(np.int64).min))
    reps = members.select("node", F.coalesce("rep.doc_id", none).alias("_id"), F.col("rep.key").alias("_key"))
    small = keyed.filter(F.col("text").isNotNull()).select(F.coalesce("doc_id", none).alias("_id"), F.col("key").alias("_key"), "text")
    small = small.mapInArrow(_squeeze, "_id long, _key long, small binary")
    texts = stage(small.join(reps, ["_id", "_key"]).select("node", "small"), "near-texts")

    def product(units: DataFrame) -> DataFrame:
        dealt = texts.join(units, "node").select("block", "node", "small").repartition(width, "block")
        return stage(dealt.sortWithinPartitions("block", "node").mapInArrow(_multiplier(rule), "a long, b long"), "near-product")

    links = product(_first_units(members.select("node", "root", "w")))
    many = members.groupBy("root").agg(F.sum("w").alias("total")).filter(F.col("total") > BLOCK).select("root")
    if not many.isEmpty():
        cut = members.join(many, "root").select("node", "root", "level", "w")
        comps = components(links.join(cut.select("node"), F.col("a") == F.col("node"), "left_semi"), "near-first")
        marked = cut.join(comps.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        links = links.unionByName(product(_second_units(stage(marked, "near-marked"))))
    linked_nodes = components(links, "near-links")
    grouped = stage(
        nodes.join(linked_nodes, "node", "left").select("node", F.coalesce("root", "node").alias("group"), "rep.doc_id"),
        "near-groups",
    )
    least = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    of_node = stage(grouped.join(least, "group").select("node", "group", "component_id"), "near-components")
    shown = ["doc_id", "key", "n_shingles", "component_id", "group"]
    empty = rows.filter("n_shingles = 0").select(
        "doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group")
    )
    return rows.filter("n_shingles > 0").join(of_node, "node").select(*shown).unionByName(empty.select(*shown))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of `near_groups`, a row for each row of `docs`."""
    return near_groups(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The rows of `docs` that stay: of each group the one of least doc_id (then of least text hash).

    Rows with an empty set stay. Repeated rows (one doc_id, one text) are one document and stay once.
    """
    found = near_groups(docs, rule)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = found.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min(order).alias("rep")).select("rep.doc_id", "rep.key")
    stay = first.unionByName(found.filter(F.col("group").isNull()).select("doc_id", "key")).distinct()
    stay = stage(stay.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")), "near-stay")
    none = F.lit(int(np.iinfo(np.int64).min))
    # One missing id and the least long would meet here; the text hash keeps them apart.
    rows = docs.withColumns({"_at": F.coalesce(F.col("doc_id").cast("long"), none), "_hash": F.xxhash64("text")})
    stay = stay.select(F.coalesce("_id", none).alias("_at"), F.col("_key").alias("_hash"))
    return rows.join(stay, ["_at", "_hash"], "left_semi").dropDuplicates(["_at", "_hash"]).select(*docs.columns)

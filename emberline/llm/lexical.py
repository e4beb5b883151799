"""Ranked lexical search of many queries at once, with their common parts evaluated once.

Terms that occur in the same set of items are one leaf: a shared term set whose partial score of a document is added
up once. Items are then lists of leaves, in one order, and pairs of neighbours that two items or more have in common
become a node of their own, again and again, until no pair repeats. What is left is a DAG: a document's accumulators are
filled at the leaves, summed at each node from two below it, and an item adds up the few nodes that remain of it.

Items come in blocks of a set number of terms. A block's DAG is sent to the tasks, every document is read against it,
and a task lets out the best documents it saw for each item. No document crosses a shuffle.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emberline.llm.texts import PLAIN_WORDS, Known, Words, chunks, reach_package, words
from emberline.session import stage

TOP = 50
#: Terms of items sent to the tasks at once, accumulators held at once, and candidates a task holds before it ranks them.
BLOCK, CELLS, HELD = 1 << 16, 1 << 22, 400_000
#: Places that an item's candidates of all tasks are dealt to before they meet.
SPREAD = 64
MATCHES = "item int, doc_id long, score long"


def item_terms(benchmark: DataFrame) -> DataFrame:
    """item_id, term (its hash): the distinct terms of each item. Rows of one item_id are one item."""
    reach_package(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                found = words(texts, PLAIN_WORDS, fold=True)
                owner = np.repeat(np.arange(len(texts)), found.counts)
                ids = batch.column(0).slice(at, len(texts)).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found.hashes().view(np.int64))], names=["item_id", "term"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "item_id long, term long").distinct()


@dataclass
class Sharing:
    """Leaves are numbered first, then the nodes, each the sum of the two in its row of `pairs`; `levels` are ranges of
    nodes that depend on earlier ones only. `parts` of all items lie in a row, those of item i from `first[i]` on."""

    leaf: np.ndarray
    leaves: int
    pairs: np.ndarray
    levels: list[tuple[int, int]]
    parts: np.ndarray
    first: np.ndarray

    @property
    def nodes(self) -> int:
        return self.leaves + len(self.pairs)


def share(items: list[list[int]], terms: int) -> Sharing:
    """The DAG of items given by their terms' numbers; every item has a term, and every term an item."""
    held: list[list[int]] = [[] for _ in range(terms)]
    for i, own in enumerate(items):
        for t in own:
            held[t].append(i)
    # Terms of the same items are one leaf; leaves of many items come first, so that items begin alike.
    groups = sorted({tuple(h) for h in held}, key=lambda g: (-len(g), g))
    number = {g: n for n, g in enumerate(groups)}
    leaf = np.array([number[tuple(h)] for h in held], np.int64)
    lists: list[list[int]] = [[] for _ in items]
    for n, group in enumerate(groups):
        for i in group:
            lists[i].append(n)
    pairs: list[tuple[int, int]] = []
    levels = []
    while True:
        seen = Counter(p for own in lists for p in zip(own, own[1:], strict=False))
        common = {p for p, n in seen.items() if n > 1}
        known: dict[tuple[int, int], int] = {}
        start = len(pairs)
        uses: Counter = Counter()
        chosen = []
        for own in lists:  # where two common pairs overlap, the more frequent one is taken
            at, taken = 0, []
            while at < len(own) - 1:
                pair, after = (own[at], own[at + 1]), tuple(own[at + 1 : at + 3])
                if pair in common and (after not in common or seen[pair] >= seen[after]):
                    taken.append(at)
                    uses[pair] += 1
                    at += 2
                else:
                    at += 1
            chosen.append(taken)
        for i, (own, taken) in enumerate(zip(lists, chosen, strict=True)):
            new, at = [], 0
            for t in taken:
                pair = (own[t], own[t + 1])
                if uses[pair] < 2:
                    continue
                if pair not in known:
                    known[pair] = len(groups) + len(pairs)
                    pairs.append(pair)
                new += [*own[at:t], known[pair]]
                at = t + 2
            lists[i] = new + own[at:]
        if len(pairs) == start:
            break
        levels.append((start, len(pairs)))
    first = np.concatenate(([0], np.cumsum([len(own) for own in lists])))[:-1]
    return Sharing(leaf, len(groups), np.array(pairs, np.int64).reshape(-1, 2), levels, np.concatenate([np.array(own, np.int64) for own in lists]), first)


def evaluate(dag: Sharing, term: np.ndarray, doc: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
    """Scores (a row an item, a column a document) of the values that documents give to terms."""
    sums = np.zeros((dag.nodes, docs), np.int64)
    np.add.at(sums.reshape(-1), dag.leaf[term] * docs + doc, value)
    for lo, hi in dag.levels:
        sums[dag.leaves + lo : dag.leaves + hi] = sums[dag.pairs[lo:hi, 0]] + sums[dag.pairs[lo:hi, 1]]
    return np.add.reduceat(sums[dag.parts], dag.first, axis=0)


@dataclass
class Corpus:
    """Documents with a term, all terms of theirs, and of each term sent out the documents that hold it."""

    documents: int
    length: int
    holders: np.ndarray

    def weights(self) -> np.ndarray:
        n = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(n / (2 * df + 1))) for df in self.holders.tolist()], np.int64)


def _postings(found: Words, known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and number of occurrences of each known term in each document of a chunk."""
    at, nth = known.find(found.hashes())
    pairs, many = np.unique(found.text_of(at) * max(1, len(known.keys)) + nth, return_counts=True)
    doc, term = np.divmod(pairs, max(1, len(known.keys)))
    return doc, term, many


def survey(docs: DataFrame, keys: np.ndarray) -> Corpus:
    """One pass over all documents for the counts that weights and lengths are made of."""
    shared = docs.sparkSession.sparkContext.broadcast(Known(keys.view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        holders, some, length = np.zeros(len(known.keys), np.int64), 0, 0
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                found = words(texts, PLAIN_WORDS, fold=True)
                some += int((found.counts > 0).sum())
                length += len(found.starts)
                holders += np.bincount(_postings(found, known)[1], minlength=len(holders))
        at = np.flatnonzero(holders)
        numbers = np.concatenate((at, [-1, -2]))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.concatenate((holders[at], [some, length])))], names=["term", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term long, n long")
    sums = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # a row a term of the block
    return Corpus(sums.get(-1, 0), sums.get(-2, 0), np.array([sums.get(i, 0) for i in range(len(keys))], np.int64))


class _Best:
    """The best `top` documents of each item so far; a missing doc_id is later than all others."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.floor = np.ones(items, np.int64)  # a score of 0 is no match
        self.held: list[tuple[np.ndarray, ...]] = []
        self.many = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.floor[:, None])
        if len(item):
            self.held.append((item, scores[item, at], none[at], ids[at]))
            self.many += len(item)
            if self.many > HELD:
                self.rank()

    def rank(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return (np.zeros(0, np.int64),) * 4
        item, score, none, ids = (np.concatenate(p) for p in zip(*self.held, strict=True))
        order = np.lexsort((ids, none, -score, item))
        item = item[order]
        first = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        order, item, place = order[place < self.top], item[place < self.top], place[place < self.top]
        kept = (item, score[order], none[order], ids[order])
        full = place == self.top - 1
        self.floor[item[full]] = kept[1][full]
        self.held, self.many = [kept], len(item)
        return kept


def _searcher(shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, dag, weights, corpus, items = shared.value
        best = _Best(items, top)
        step = max(1, CELLS // (dag.nodes + len(dag.parts)))
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                found = words(texts, PLAIN_WORDS, fold=True)
                doc, term, many = _postings(found, known)
                if not len(doc):
                    continue
                length = 50 + 50 * found.counts * corpus[0] // corpus[1]
                value = weights[term] * (1_000_000_000 * many // (1000 * many + 20 * length[doc]))
                own = batch.column(0).slice(at, len(texts))
                none = own.is_null().to_numpy(zero_copy_only=False)
                ids = own.fill_null(0).to_numpy(zero_copy_only=False)
                rows, doc = np.unique(doc, return_inverse=True)
                for lo in range(0, len(rows), step):
                    cut = slice(*np.searchsorted(doc, (lo, lo + step)))
                    here = rows[lo : lo + step]
                    best.add(evaluate(dag, term[cut], doc[cut] - lo, value[cut], len(here)), ids[here], none[here])
        item, score, none, ids = best.rank()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=none.astype(bool)), pa.array(score, pa.int64())], names=["item", "doc_id", "score"]
        )

    return run


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """Per item: its `top` documents of highest score above 0, as item_id, rank, doc_id, score.

    Equal scores go by doc_id, a missing one last. Each row of `docs` is a document: repeated rows count and are found
    each. Null and empty texts and items have no term; such an item finds nothing. Items with one item_id are one item
    of all their terms, those without an id too. Empty tables give an empty result; other columns are not looked at.
    Equal 64-bit hashes are taken for equal terms.
    """
    spark = docs.sparkSession
    reach_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = stage(item_terms(benchmark), "search-terms")
    blocks = max(1, -(-terms.count() // block))
    out = None
    for nth in range(blocks):
        part = terms if blocks == 1 else terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == nth)
        own: dict[int | None, list[int]] = {}
        for row in part.collect():  # about `block` rows, and whole items
            own.setdefault(row["item_id"], []).append(row["term"])
        if not own:
            continue
        names = sorted(own, key=lambda i: (i is None, i))
        keys = Known(np.array([t for held in own.values() for t in held], np.int64).view(np.uint64)).keys
        lists = [np.searchsorted(keys, np.array(own[i], np.int64).view(np.uint64)).tolist() for i in names]
        corpus = survey(docs, keys)
        if not corpus.length:
            continue
        plan = (Known(keys), share(lists, len(keys)), corpus.weights(), (corpus.documents, corpus.length), len(names))
        found = docs.mapInArrow(_searcher(spark.sparkContext.broadcast(plan), top), MATCHES)
        by_score = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        some = W.partitionBy("item", "_place").orderBy(*by_score)
        found = found.withColumn("_place", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
        found = found.withColumn("_nth", F.row_number().over(some)).filter(F.col("_nth") <= top)
        ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*by_score))).filter(F.col("rank") <= top)
        named = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
        ranked = stage(ranked.join(named, "item").select("item_id", "rank", "doc_id", "score"), "search-block")
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out

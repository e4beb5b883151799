from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberline.llm import mixing
from emberline.llm.queries import op4_source_mix
from tests.llm.conftest import blank_words, rows_of, texts

SCHEMA = "doc_id long, text string, source string"


def wanted_targets(docs, weights=(5, 2, 1), cap=3):
    size = Counter()
    for _, text, source in docs:
        size[source] += len(blank_words(text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(size.values())), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= cap * size[s]]
        if not full:
            return target | {s: left * weight[s] / total for s in open_}, size
        for s in full:
            target[s] = float(cap * size[s])
        left -= sum(cap * size[s] for s in full)
        open_ -= set(full)
    return target, size


def many(n=400):
    return [(i, "w " * (1 + (i * 7919) % 37), ("a", "b", "c", "d", None)[i % 11 % 5]) for i in range(n)]


def check(plan, docs, slack):
    target, size = wanted_targets(docs)
    taken, largest = Counter(), Counter()
    for r in plan.collect():
        s = r["source"]
        largest[s] = max(largest[s], r["size"])
        assert abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) and r["source_size"] == size[s]
        assert len(r["draws"]) <= 3
        taken[s] += r["size"] * len(r["draws"])
    assert all(abs(taken[s] - target[s]) <= min(slack, largest[s] / 2) for s in target), (taken, target)


def test_targets_and_draws(spark):
    check(mixing.mix_plan(texts(spark, many(), SCHEMA)), many(), 5)


def test_many_blocks(spark):
    check(mixing.mix_plan(texts(spark, many(), SCHEMA), mixing.Mix(cells=64, per_block=4)), many(), 40)


def test_a_source_at_its_cap(spark):
    docs = [(1, "w " * 5, "a"), *[(10 + i, "w " * 9, "b") for i in range(30)]]
    check(mixing.mix_plan(texts(spark, docs, SCHEMA)), docs, 5)
    row = mixing.mix_plan(texts(spark, docs, SCHEMA)).filter("doc_id = 1").first()
    assert (row["target"], len(row["draws"])) == (15.0, 3)


@pytest.mark.parametrize("copies, words", [(200, 31), (1000, 3), (7, 900), (2, 50)])
def test_repeated_rows_are_documents_each(spark, copies, words):
    """A document that is there many times is taken as often as the target says, not all of its copies or none."""
    docs = [(1, "w " * words, "a")] * copies + [(i, "w " * (1 + i % 5), "a") for i in range(2, 6)]
    docs += [(1000 + i, "w " * (1 + i % 9), ("b", None)[i % 2]) for i in range(copies)]
    mix = mixing.Mix(seed=copies, spread=3 if copies % 8 else 4096)
    check(mixing.mix_plan(texts(spark, docs, SCHEMA).repartition(3), mix), docs, words)


def test_copies_are_chosen_exactly(spark):
    rows = spark.range(0, 1000, numPartitions=4).selectExpr("'k' AS _key", "id % 2 AS _place", "if(id % 2 = 0, 137L, 500L) AS _many", "id")
    for spread in (1, 7, 4096):
        got = mixing._chosen(rows, mixing.Mix(spread=spread))
        assert sorted(map(tuple, got.groupBy("_place").agg(F.count_if("_last"), F.count("*")).collect())) == [(0, 137, 500), (1, 500, 500)]


def test_the_report_is_the_plan(spark):
    docs = texts(spark, many(), SCHEMA)
    wanted = mixing.mix_plan(docs).selectExpr(
        "doc_id", "size", "source_size", "target", "size * size(draws) AS taken", "array_join(transform(draws, d -> string(d.shard)), ',') AS shards")
    assert rows_of(mixing.mix_report(docs)) == rows_of(wanted)


def test_reruns_and_layouts_agree(spark):
    docs = texts(spark, many(), SCHEMA)
    assert rows_of(mixing.mix_plan(docs)) == rows_of(mixing.mix_plan(docs.repartition(7)))


def test_draws_are_disjoint_and_quotas_exact(spark):
    mix = mixing.Mix(cells=64, per_block=4)
    rows = mixing.mixed(texts(spark, many(), SCHEMA), mix).collect()
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows)
    assert {r["shard"] for r in rows} == set(range(2**mix.depth))
    units = spark.createDataFrame([(k, u) for k, n in (("x", 50), ("y", 13), ("z", 1)) for u in range(n)], "_key string, _unit int")
    leaves = Counter(r["_node"] for r in mixing._shards(units, mix).collect())
    assert sum(leaves.values()) == 64 and set(leaves.values()) == {4}


def test_odd_rows(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "q r s", None), (5, "w " * 30_000, "b"), (None, None, None)]
    got = mixing.mix_plan(texts(spark, [(*d, 1, "z") for d in docs], SCHEMA + ", size int, draws string"))
    assert got.count() == len(docs) and got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "draws"]
    assert {r["size"] for r in got.filter("doc_id = 3").collect()} == {2}
    assert mixing.mix_plan(texts(spark, [], SCHEMA)).count() == 0
    assert mixing.mixed(texts(spark, [(1, None, "a")], SCHEMA)).count() == 0


def test_registered_query(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    target, size = wanted_targets(docs)
    got = op4_source_mix(spark, "/root/testdata/sf0.001")
    source = {d: s for d, _, s in docs}
    rows = got.collect()
    assert len(rows) == len(docs) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert all(abs(r["target"] - target[source[r["doc_id"]]]) < 1e-6 * r["target"] for r in rows)
    assert got.agg(F.sum("size")).first()[0] == sum(size.values())
    taken, largest = Counter(), Counter()
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
        largest[source[r["doc_id"]]] = max(largest[source[r["doc_id"]]], r["size"])
        assert len([x for x in r["shards"].split(",") if x]) * r["size"] == r["taken"]
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)

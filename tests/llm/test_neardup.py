import collections
import random

import numpy as np
import pytest

from emberline.llm import neardup
from emberline.llm.graph import array_components, components
from emberline.llm.queries import op9_ngram_jaccard
from tests.llm.conftest import blank_words, clash, rows_of, texts


def sets_of(docs, width=4):
    out = []
    for _, text in docs:
        w = blank_words(text, fold=True)
        out.append({tuple(w[i : i + width]) for i in range(max(1 if w else 0, len(w) - width + 1))})
    return out


def brute(docs, part=85, width=4):
    sets = sets_of(docs, width)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= part * len(a | sets[j]):
                root[find(i)] = find(j)
    least = collections.defaultdict(lambda: 10**18)
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least[find(i)], d)
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def copies(seed, families=12, each=12):
    rng, docs = random.Random(seed), []
    for _ in range(families):
        base = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))]
        for _ in range(each):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                kind, i = rng.randrange(3), rng.randrange(len(w) + 1)
                if kind == 0 and i < len(w):
                    w[i] = rng.choice("abcdefgh")
                elif kind == 1:
                    w.insert(i, rng.choice("abcdefgh"))
                elif len(w) > 1 and i < len(w):
                    del w[i]
            docs.append((len(docs), " ".join(w)))
    return docs


ODD = [(9000, None), (9001, ""), (9002, " \t"), (9003, "A b"), (9004, "a B"), (9004, "a B"), (9005, "a"), (9006, "x y z " * 30_000)]


def test_families_and_odd_texts(spark):
    docs = copies(5) + ODD
    assert rows_of(neardup.near_duplicates(texts(spark, docs).repartition(3))) == brute(docs)


@pytest.mark.parametrize("limits", [dict(BLOCK=8_000), dict(BLOCK=3_000, LIST=2, FOLD=500)])
def test_blocks_and_lists_of_any_size_lose_no_link(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(neardup, name, value)
    docs = copies(6, families=4, each=30)
    assert rows_of(neardup.near_duplicates(texts(spark, docs).repartition(3))) == brute(docs)


def passages(seed, n):
    """Texts of which most share one long passage without being near copies, and some that are."""
    rng, docs = random.Random(seed), []
    passage = [f"p{i}" for i in range(30)]
    for d in range(n):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(3, 40))]
        w = own + passage if d % 5 else own
        docs.append((3 * d, " ".join(w)))
        if d % 7 == 0:
            docs.append((3 * d + 1, " ".join(w + ["z"])))
    return docs


@pytest.mark.parametrize("part", [85, 80])
def test_a_shared_passage_makes_no_cluster(spark, monkeypatch, part):
    docs, sizes = passages(3, 400), []
    whole = neardup._first_units

    def seen(members):
        sizes.append(members.groupBy("root").count().agg({"count": "max"}).first()[0])
        return whole(members)

    monkeypatch.setattr(neardup, "_first_units", seen)
    found = neardup.near_groups(texts(spark, docs).repartition(4), neardup.Rule(shingle=4, part=part))
    assert rows_of(found.select("doc_id", "n_shingles", "component_id")) == brute(docs, part)
    # Hundreds of texts share signatures through the passage; those with few words of their own may be copies.
    assert sizes[0] <= 40


def random_sets(rng, n, size):
    """Sets that are copies of a few with some members changed."""
    bases = [rng.integers(0, 2**62, size) for _ in range(3)]
    out = []
    for _ in range(n):
        own = bases[rng.integers(0, 3)].copy()
        change = rng.integers(0, max(1, size // 3))
        own[rng.integers(0, size, change)] = rng.integers(0, 2**62, change)
        out.append(np.unique(own[: size - rng.integers(0, size // 6 + 1)].astype(np.uint64)))
    return out


def test_parities_bound_the_difference_and_tell_strangers_apart():
    """Sets of any two sizes: never more bits than differing n-grams; sets that share half are far beyond the bound."""
    rng = np.random.default_rng(9)
    sizes = (1, 5, 60, 500, 520, 1100, 5000, 20_000)
    shared = rng.integers(0, 2**62, max(sizes)).astype(np.uint64)
    grams = [np.concatenate((shared[: n // 2], rng.integers(0, 2**62, n - n // 2).astype(np.uint64))) for n in sizes for _ in range(2)]
    bounds = np.concatenate(([0], np.cumsum([len(g) for g in grams])))
    parity = neardup.Parities.of(np.concatenate(grams), bounds)
    x, y = (a.ravel() for a in np.indices((len(grams), len(grams))))
    bits = parity.apart(x, y)
    differ = np.array([len(np.setxor1d(grams[i], grams[j])) for i, j in zip(x, y, strict=True)])
    assert (bits <= differ).all() and (bits[x == y] == 0).all()
    size = np.diff(bounds)
    near = (x != y) & (size[x] == size[y]) & (size[x] >= 60)
    assert (bits[near] > neardup.reach(size[x], size[y], neardup.Rule(5, 80))[near]).all()
    again = neardup.Parities.read([parity.row(i) for i in range(len(grams))])
    assert (again.apart(x, y) == bits).all() and max(parity.wide) == neardup.WIDE and min(parity.wide) == neardup.NARROW


@pytest.mark.parametrize("size", [8, 40, 300, 700])
def test_folding_and_parities_keep_linked_sets_tied(size):
    """Whatever task a set is in, linked sets that share a signature end up in one cluster."""
    rng = np.random.default_rng(size)
    for _ in range(30):
        grams = random_sets(rng, 24, size)
        bounds = np.concatenate(([0], np.cumsum([len(g) for g in grams])))
        flat = np.concatenate(grams)
        n, parity, node = np.diff(bounds), neardup.Parities.of(flat, bounds), neardup.set_names(flat, bounds)
        links = [
            (i, j) for i in range(24) for j in range(i)
            if neardup.linked(np.array([len(np.intersect1d(grams[i], grams[j]))]), n[[i]], n[[j]])[0]
        ]
        for i, j in links:
            assert parity.apart(np.array([i]), np.array([j]))[0] <= neardup.reach(n[i], n[j])
        task = rng.integers(0, 3, 24)
        a, b, rest = [], [], []
        for t in range(3):
            own = np.flatnonzero(task == t)
            _, row, slack, x, y = neardup.fold(np.zeros(len(own), np.uint64), own, node, n, parity, neardup.RULE)
            a.append(x)
            b.append(y)
            rest += list(zip(row.tolist(), slack.tolist(), strict=True))
        row, slack = np.array([r for r, _ in rest]), np.zeros(24, np.int64)
        slack[row] = [w for _, w in rest]
        x, y = neardup.tied(row, node, n, parity, slack, neardup.RULE)
        nodes, roots = array_components(np.concatenate([*a, x, node]), np.concatenate([*b, y, node]))
        root = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
        assert all(root[int(node[i])] == root[int(node[j])] for i, j in links)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for size in [*range(1, 60), 100, 333, 1000]:
        base = rng.integers(0, 2**62, size).astype(np.uint64)
        for change in range(0, size // 8 + 2):
            other = np.concatenate((base[change:], rng.integers(0, 2**62, rng.integers(0, change + 1)).astype(np.uint64)))
            both = size - change
            if both < 1 or not neardup.linked(np.array([both]), np.array([size]), np.array([len(other)]))[0]:
                continue
            a, b = np.sort(base), np.sort(other)
            key, owner = neardup.signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist()), (size, change, len(other))


def test_rules_of_other_widths_and_parts(spark):
    rule = neardup.Rule(shingle=5, part=80)
    docs = copies(8) + ODD
    sets = []
    for _, text in docs:
        w = blank_words(text, fold=True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1 if w else 0, len(w) - 4))})
    links = [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    least = {i: i for i in range(len(docs))}
    nodes, roots = array_components(*(np.array(x) for x in zip(*links, strict=True)))
    least.update(zip(nodes.tolist(), roots.tolist(), strict=True))
    wanted = sorted({(docs[least[i]][0], docs[least[i]][1]) for i in range(len(docs))}, key=str)
    assert rows_of(neardup.one_of_each(texts(spark, docs).repartition(3), rule)) == wanted
    assert rows_of(neardup.one_of_each(texts(spark, docs))) != wanted


def test_dense_and_sparse_columns_agree(monkeypatch):
    rng = np.random.default_rng(2)
    grams = [np.unique(rng.integers(0, 60, 50)).astype(np.uint64) for _ in range(80)]
    wanted = [
        (i, j) for i in range(80) for j in range(i + 1, 80)
        if 100 * len(np.intersect1d(grams[i], grams[j])) >= 85 * len(np.union1d(grams[i], grams[j]))
    ]
    for dense in (0, 32, 1000):
        monkeypatch.setattr(neardup, "DENSE", dense)
        assert list(zip(*(x.tolist() for x in neardup.block_links(grams)), strict=True)) == wanted


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 299)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "test").collect())
    wanted = {**dict.fromkeys(range(41), 0), 100: 100, **{200 + i: 100 for i in range(30)}, 300: 299, 299: 299}
    assert got == wanted
    nodes, roots = array_components(*(np.array(x) for x in zip(*edges, strict=True)))
    assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == wanted


def test_empty_table_and_missing_ids(spark):
    assert neardup.near_duplicates(texts(spark, [])).count() == 0
    docs = texts(spark, [(None, "a b c d e"), (None, "q r s t"), (3, "a b c d e"), (None, None)])
    assert rows_of(neardup.near_duplicates(docs)) == sorted([(None, 2, 3), (None, 1, None), (3, 2, 3), (None, 0, None)], key=str)


def test_texts_without_an_id_are_told_apart(spark):
    a, b = clash(spark)
    docs = [(None, a), (None, b), (3, b + " z y x w v u t s"), (None, a)]
    assert rows_of(neardup.one_of_each(texts(spark, docs))) == sorted({*docs}, key=str)


def test_one_of_each_group_stays(spark):
    docs = [(4, "a b c d e", 1), (2, "a b c d e", 2), (2, "a b c d e", 2), (7, "z", 3), (8, None, 4), (9, None, 5), (None, "a b c d e", 6)]
    found = neardup.one_of_each(texts(spark, docs, "doc_id long, text string, key int"))
    assert rows_of(found) == sorted([(2, "a b c d e", 2), (7, "z", 3), (8, None, 4), (9, None, 5)], key=str)


def test_registered_query(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(op9_ngram_jaccard(spark, "/root/testdata/sf0.001")) == brute(docs)

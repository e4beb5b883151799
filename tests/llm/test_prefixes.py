import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import prefixes
from emberline.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """The contract's rebuilt conversations of (conv_id, turn, role, text), without ties of one turn number."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def trie(convs):
    """Nodes of {conv_id: turns} by walking them one by one."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(inside) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(inside), len(node), min(members[node[:-1]]) if node else -1, len(inside), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


def nodes(df):
    assert df.columns == prefixes.RESULT
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def frame(spark, convs):
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.data())
def test_sparse_minima_and_extents(values, data):
    values = np.array(values, np.int64)
    table = prefixes.sparse(values)
    pairs = [(a, b) for a in range(len(values)) for b in range(a, len(values))]
    lo, hi = (np.array(p) for p in zip(*pairs, strict=True))
    assert prefixes.minima(table, lo, hi).tolist() == [values[a : b + 1].min() for a, b in pairs]
    row = data.draw(st.integers(0, len(values) - 1))
    depth = data.draw(st.integers(1, 6))
    left = row
    while left and values[left] >= depth:
        left -= 1
    right = row
    while right + 1 < len(values) and values[right + 1] >= depth:
        right += 1
    found = prefixes.extents(table, np.array([row]), np.array([depth]))
    assert (found[0][0], found[1][0]) == (left, right)


def families(seed, n):
    """Conversations that share prefixes, a third of them one and the same, some a prefix of others, some empty."""
    rng = np.random.default_rng(seed)
    out = {}
    for c in range(n):
        if c % 3 == 0:
            out[c] = [("user", "hello"), ("bot", "hi there")]
        elif c % 50 == 1:
            out[c] = []
        else:
            size = int(rng.integers(1, 7))
            out[c] = [(("user", "bot")[i % 2], "hello" if i == 0 and c % 2 else f"t{rng.integers(0, 3)}") for i in range(size)]
    return out


@pytest.mark.parametrize("turns", [10_000, 40, 7])
def test_ranges_of_any_size_give_the_trie(spark, turns):
    convs = families(3, 400)
    paths = spark.createDataFrame(
        [(c, [dict(chars=len(t[1]), hash=zlib.crc32(repr(t).encode())) for t in turns_]) for c, turns_ in convs.items()],
        "conv_id long, turns array<struct<chars:long,hash:long>>",
    )
    assert nodes(prefixes.prefix_trie(paths, turns)) == trie(convs)


def test_rebuilt_conversations(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in [*range(0, 330), 705, 1_000_000_007]:
        for i in range(int(rng.integers(1, 8))):
            rows.append((c, None if i == 0 and c % 7 == 0 else i, None if c % 11 == 0 else ("user", "bot")[i % 2], None if c % 13 == 0 else f"é{rng.integers(0, 3)}"))
    rows += [(None, 1, "user", "nobody's"), (8, 99, "user", "long " * 50_000)]
    got = nodes(prefixes.prefix_trie(prefixes.branched(spark.createDataFrame(rows, SCHEMA)), 100))
    assert got == trie(rebuilt(rows))


def test_a_tie_of_turns_and_repeated_rows(spark):
    rows = [(200, 1, "user", "bb"), (200, 1, "user", "a"), (200, 1, "user", "a"), (201, 1, "user", "a"), (201, 2, "user", "a"), (201, 3, "user", "bb")]
    schema = SCHEMA + ", depth int, key string"
    got = prefixes.sequences(spark.createDataFrame([(*r, 1, "k") for r in rows], schema)).collect()
    assert [t["chars"] for t in got[0]["turns"]] == [1, 1, 2] and got[0]["turns"] == got[1]["turns"]


def test_only_conversations_without_turns_and_no_conversation(spark):
    none = spark.createDataFrame([(4, []), (2, [])], "conv_id long, turns array<struct<chars:long,hash:long>>")
    assert nodes(prefixes.prefix_trie(none)) == trie({4: [], 2: []})
    assert prefixes.prefix_trie(none.limit(0)).count() == 0
    assert prefixes.prefix_trie(prefixes.branched(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))).count() == 0


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(op12_prefix_trie(spark, "/root/testdata/sf0.001")) == trie(rebuilt(rows))

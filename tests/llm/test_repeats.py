import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from emberline.llm import repeats
from emberline.llm.queries import op3_substring_dedup
from tests.llm.conftest import blank_words, clash, rows_of, texts


def brute(docs, k=50):
    late = repeats.LAST
    first, split = {}, [(d, blank_words(t)) for d, t in docs]
    for d, w in split:
        for s in range(len(w) - k + 1):
            key = tuple(w[s : s + k])
            first[key] = min(first.get(key, late), late if d is None else d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            if first[tuple(w[s : s + k])] < (late if d is None else d):
                gone[s : s + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def report(found):
    n = F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + c["end"] - c["start"])
    return rows_of(found.select("doc_id", "n_words", n, F.sha2("kept", 256)))


def test_random_and_odd_texts(spark):
    rng = random.Random(3)
    docs = [(rng.choice([1, 2, 3, 4, 5, None]), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for _ in range(60)]
    docs += [(9, None), (9, None), (3, ""), (7, "é " * 300), (8, "é\t" * 300), (8, "é\t" * 300), (10, "q w e r t y " * 20_000)]
    assert report(repeats.cut_repeats(texts(spark, docs).repartition(5), 5)) == brute(docs, 5)


def test_texts_without_an_id_are_told_apart(spark):
    a, b = clash(spark)
    docs = [(None, a), (None, b), (1, a + " more")]
    assert report(repeats.cut_repeats(texts(spark, docs), 5)) == brute(docs, 5)


def test_folding_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FOLD", 40)
    rng = random.Random(4)
    docs = [(i % 17, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))) for i in range(50)]
    emitted = list(repeats._emitter(4, 3)(iter([_batch(docs)])))
    dealt = sorted((b.column(0)[i].as_py(), n, i) for n, b in enumerate(emitted) for i in range(b.num_rows))
    ordered = [emitted[n].slice(i, 1) for _, n, i in dealt]
    found = list(repeats._finder(5)(iter(ordered)))
    dealt = sorted((b.column(0)[i].as_py(), n, i) for n, b in enumerate(found) for i in range(b.num_rows))
    gathered = repeats._gather(iter([found[n].slice(i, 1) for _, n, i in dealt]))
    marks = [(r["doc_id"], r["key"], p) for m in gathered for r in m.to_pylist() for p in _places(r["places"])]
    late = {}
    for d, t in docs:
        w = t.split()
        for s in range(len(w) - 3):
            late.setdefault(tuple(w[s : s + 4]), set()).add(d)
    wanted = {(d, i, s) for i, (d, t) in enumerate(docs) for s in range(len(t.split()) - 3) if min(late[tuple(t.split()[s : s + 4])]) < d}
    assert sorted(marks) == sorted(wanted)


def _batch(docs):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in docs], pa.int64()), pa.array(range(len(docs)), pa.int32()), pa.array([t for _, t in docs])],
        names=["doc_id", "key", "text"],
    )


def _places(data):
    return np.cumsum(repeats.unpack(np.frombuffer(data, np.uint8))[0]).tolist()


def test_numbers_survive_packing():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2**31, 2**62])
    packed, sizes = repeats.pack(values)
    assert repeats.unpack(packed)[0].tolist() == values.tolist() and sizes.sum() == len(packed)
    assert len(repeats.unpack(repeats.pack(np.zeros(0, int))[0])[0]) == 0


def test_empty_table_and_other_columns(spark):
    docs = texts(spark, [(1, "a b", "x", "y")], "doc_id long, text string, kept string, key string")
    assert rows_of(repeats.cut_repeats(docs)) == [(1, 2, [], "a b")]
    assert repeats.cut_repeats(docs.limit(0)).count() == 0


def test_registered_query(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(op3_substring_dedup(spark, "/root/testdata/sf0.001")) == brute(docs)


def test_a_task_holds_its_windows_once():
    """Bytes that a fold and a bucket take for each window at most."""

    def peak(work):
        tracemalloc.start()
        try:
            return list(work), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    docs = [" ".join(map(str, range(i * 300, i * 300 + 300))) for i in range(3000)]
    windows, ids = 3000 * 251, pa.array(np.arange(3000))
    docs = pa.RecordBatch.from_arrays([ids, ids, pa.array(docs)], names=["doc_id", "key", "text"])
    folded, held = peak(repeats._emitter(50, 1)(iter([docs])))
    assert held < 155 * windows
    twice = pa.RecordBatch.from_pylist(sum((f.to_pylist() for f in folded), []) * 2, schema=folded[0].schema)
    dealt, held = peak(repeats._finder(4)(iter([twice])))
    assert dealt == [] and held < 80 * 2 * windows


def test_files_and_partitions_follow_the_text_and_not_the_shuffle(spark, tmp_path):
    """A few small texts make a few files, however wide the shuffle is, and a bucket is a partition without a sort."""
    settings = {
        "spark.sql.shuffle.partitions": "60",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    rng = random.Random(5)
    docs = [(i % 90, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(200)]
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = repeats.cut_repeats(texts(spark, docs).repartition(7), 5)
        found.write.parquet(str(tmp_path / "out"))
        assert 1 <= len(list((tmp_path / "out").glob("part-*"))) <= spark.sparkContext.defaultParallelism
        assert report(spark.read.parquet(str(tmp_path / "out"))) == brute(docs, 5)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "Sort [bucket" not in plan and "Sort [deal" not in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)

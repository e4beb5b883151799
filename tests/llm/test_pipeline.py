from emberline.llm import personal
from emberline.llm.queries import language_model
from emberline.llm.langid import predict
from tests.llm import test_leaks, test_mixing, test_neardup

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def step(name, spark, docs):
    return dict(pipeline.STAGES)[name](spark, docs, SF)


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_against_brute_force(spark, documents):
    rows = documents.collect()
    known = step("language_id", spark, documents)
    langs, _, unsure = predict(language_model(documents), [r["text"] for r in rows])
    kept = [r for r, lang, bad in zip(rows, langs, unsure, strict=True) if lang != "und" and not bad]
    assert plain(known) == sorted(map(tuple, kept), key=str) and len(kept) >= 0.98 * len(rows)

    groups = test_neardup.brute([(r["doc_id"], r["text"]) for r in kept], pipeline.NEAR.part, pipeline.NEAR.shingle)
    first = {d for d, _, root in groups if d == root}
    kept = [r for r in kept if r["doc_id"] in first]
    single = step("ngram_jaccard", spark, known)
    assert plain(single) == sorted(map(tuple, kept), key=str)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {r[0] for r in test_leaks.brute([(r["doc_id"], r["text"]) for r in kept], items) if r[-1]}
    kept = [r for r in kept if r["doc_id"] not in leaks]
    clean = step("decontamination", spark, single)
    assert plain(clean) == sorted(map(tuple, kept), key=str) and leaks

    private = step("personal_data", spark, clean)
    got = {r["doc_id"]: r for r in private.collect()}
    assert private.columns == documents.columns and set(got) == {r["doc_id"] for r in kept}
    for r in kept:
        base = personal.base_spans(r["text"])
        assert base or got[r["doc_id"]]["text"] == r["text"]
        assert not any(r["text"][s:e] in got[r["doc_id"]]["text"] for k, s, e in base if k == 0)
        assert got[r["doc_id"]]["n_chars"] == len(got[r["doc_id"]]["text"])

    mixed = step("source_mix", spark, private).collect()
    target, _ = test_mixing.wanted_targets([(r["doc_id"], r["text"], r["source"]) for r in got.values()])
    assert len({(r["doc_id"], r["copy"]) for r in mixed}) == len(mixed) and {r["doc_id"] for r in mixed} <= set(got)
    taken = sum(r["size"] for r in mixed)
    assert abs(taken - sum(target.values())) < 0.1 * sum(target.values())


def test_near_duplicates_of_five_words_and_four_fifths(spark, documents):
    base = [f"w{i}" for i in range(50)]
    near = [*base[:25], "x", *base[26:]]  # 41 of 51 five-word shingles are shared, and 43 of 51 four-word ones
    far = [*near[:10], "y", *near[11:40], "z", *near[41:]]
    rows = [(i, " ".join(w)) for i, w in enumerate((base, near, far), 1)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], documents.schema)
    assert [r["doc_id"] for r in step("ngram_jaccard", spark, docs).orderBy("doc_id").collect()] == [1, 3]


def test_clashing_columns_come_through(spark, documents):
    more = documents.selectExpr("*", "'kept' as score", "doc_id as items", "1.5 as n_words", "'z' as key")
    for name, f in pipeline.STAGES[:4]:
        out = f(spark, more, SF)
        assert out.columns == more.columns
        assert {(r["score"], r["key"], r["items"] == r["doc_id"]) for r in out.collect()} == {("kept", "z", True)}, name


def test_run(spark):
    rows = pipeline.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "text", "copy", "shard"} <= set(rows.columns)


def test_stages_take_odd_rows(spark, documents):
    schema = documents.schema
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "the word of the word", None, None, 5), (3, "x", "en", "b", 1)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, f in pipeline.STAGES:
            out = f(spark, docs, SF)
            assert name == "source_mix" or out.columns == documents.columns
            out.count()

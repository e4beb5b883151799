import math
import zlib

import numpy as np

from emberline.llm import langid
from emberline.llm.queries import op1_language_id
from tests.llm.conftest import texts

SMALL = langid.Training(per_language=40)


def trained():
    rows = [(w, lang) for lang, words in (("x", "aba bab abba"), ("y", "cdc dcd ccdd"), ("z", "efe fef eeff")) for w in words.split()]
    return langid.fit([w * 3 for w, _ in rows], [v for _, v in rows], SMALL)


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 6, 9, 30):
        codes = langid.codewords(n)
        gaps = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= 2 ** (n - 2) if n <= 6 else min(gaps) >= 8
        assert (np.abs(codes.sum(0)) < n).all()
    assert langid.codewords(1).shape == (1, 1) and langid.codewords(0).shape == (0, 1)


def test_nearest_codeword_survives_a_wrong_bit():
    model = trained()
    for row in range(3):
        margins = 3 * model.codes[[row]].copy()
        margins[0, 0] *= -0.5
        best, top, gap = langid.decode(model, margins)
        assert best[0] == row and top[0] > 0.5 and gap[0] > 0


def test_decoding_by_plain_loops():
    model, rng = trained(), np.random.default_rng(2)
    margins = rng.normal(0, 2, (50, model.codes.shape[1]))
    best, top, gap = langid.decode(model, margins.copy())
    for m, b, p, g in zip(margins, best, top, gap, strict=True):
        loss = [sum(t * math.log(1 + math.exp(-c * x)) for c, t, x in zip(code, trust, m, strict=True)) for code, trust in zip(model.codes, model.trust, strict=True)]
        order = sorted(range(len(loss)), key=loss.__getitem__)
        assert b == order[0] and math.isclose(p, 1 / sum(math.exp(loss[b] - v) for v in loss))
        assert math.isclose(g, (loss[order[1]] - loss[b]) / len(m))


def test_halves_of_two_languages_are_ambiguous(spark, documents):
    """Of texts in one language almost none is flagged, of texts that change the language in the middle most are."""
    rows = [r for r in documents.collect() if r["lang"] and len((r["text"] or "").split()) >= 60]
    model = langid.train(documents)
    _, _, unsure = langid.predict(model, [r["text"] for r in rows])
    assert sum(unsure) <= 0.02 * len(rows)
    words = {}
    for r in rows:
        words.setdefault(r["lang"], []).append(r["text"].split())
    langs = sorted(words)
    mixed = [" ".join(words[a][i][:30] + words[b][i][:30]) for a in langs for b in langs if a < b for i in range(min(10, len(words[a]), len(words[b])))]
    _, _, unsure = langid.predict(model, mixed)
    assert sum(unsure) >= 0.5 * len(mixed)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "12 ?!", "c"), (4, "abab aba", "d"), (4, "abab aba", "d"), (5, "cdcd " * 300_000, None)]
    found = langid.identify(texts(spark, rows, "doc_id long, text string, score string"), trained())
    got = {r["doc_id"]: r for r in found.collect()}
    assert found.columns == ["doc_id", "text", "lang_pred", "score", "ambiguous"] and found.count() == 6
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "x", "y"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(texts(spark, []), trained()).count() == 0


def test_no_labels_give_und(spark):
    model = langid.train(spark.createDataFrame([("abc", None)], "text string, lang string"))
    assert langid.identify(texts(spark, [(1, "abc")]), model).first()["lang_pred"] == "und"


def test_one_language(spark):
    model = langid.train(spark.createDataFrame([("abc", "q")], "text string, lang string"))
    row = langid.identify(texts(spark, [(1, "zzz")]), model).first()
    assert (row["lang_pred"], row["score"]) == ("q", 1.0)


def test_held_out_accuracy(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = op1_language_id(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_copies_do_not_crowd_the_sample(spark):
    rows = [("same", "q")] * 500 + [(f"other {i}", "q") for i in range(30)]
    got, _ = langid.sample(spark.createDataFrame(rows, "text string, lang string"), langid.Training(per_language=20))
    assert len(got) == 20 and len(set(got)) == 20

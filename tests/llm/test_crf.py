import zlib

import numpy as np
from conftest import texts
from pyspark.sql import functions as F

from tracewaste.llm import crf
from tracewaste.llm.tables import id_crc

SF = "/root/testdata/sf0.01/documents.parquet"


def test_words_and_hashes():
    words = crf.words_of([b"The 12 cat", b"", b"the CAT", b"..", "été".encode()])
    assert words.lengths.tolist() == [2, 0, 2, 0, 1]
    assert words.hashes[0] == words.hashes[2] and words.hashes[1] == words.hashes[3]
    assert len(set(words.hashes.tolist())) == 3
    assert np.diff(np.append(words.starts, len(words.trigrams))).tolist() == [3, 3, 3, 3, 5]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF)
    got = crf.predict_languages(docs, id_crc(F.col("doc_id")) % 4 == 2)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and len(held) > 200
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def sampled(spark):
    rows = spark.read.parquet(SF).filter("doc_id % 3 > 0").limit(600).collect()
    return crf.fit([r["text"][:1500].encode() for r in rows], [r["lang"] for r in rows])


def test_code_switched_text(spark):
    field = sampled(spark)
    rows = spark.read.parquet(SF).filter("doc_id % 3 = 0").collect()
    by = {lang: next(r["text"] for r in rows if r["lang"] == lang and len(r["text"]) > 800) for lang in ("en", "fr", "de")}
    parts = [" ".join(by[lang].split()[:40]) for lang in ("en", "de", "fr")]
    words = crf.words_of([" ".join(parts).encode()])
    guess, _ = crf.label_probabilities(field, words)
    labels = [field.languages[i] for i in guess.argmax(axis=1)]
    third = len(labels) // 3
    right = sum(a == b for a, b in zip(labels, ["en"] * third + ["de"] * third + ["fr"] * third, strict=False))
    assert right / len(labels) > 0.85
    _, _, _, switches = crf.label_texts(field, [" ".join(parts).encode()])
    assert 2 <= switches[0] <= 12


def test_probabilities_do_not_depend_on_the_batch(spark):
    field = sampled(spark)
    some = [(t or "").encode() for t in texts(60)]
    pred, score, count, switches = crf.label_texts(field, some)
    for i, t in enumerate(some):
        p, s, c, w = crf.label_texts(field, [t])
        assert (p[0], c[0], w[0]) == (pred[i], count[i], switches[i]) and abs(s[0] - score[i]) < 1e-4


def test_odd_rows(make):
    docs, rows = make(texts(60))
    got = crf.predict_languages(docs, F.lit(False)).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    for doc_id, text, *_ in rows:
        r = by_id[doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"], r["n_words"]) == ("und", 0.0, 0)
        else:
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1


def test_nothing_to_learn_from(make, empty):
    docs, rows = make(["a b", None, "c"], [None] * 3)
    assert {(r["lang_pred"], r["score"]) for r in crf.predict_languages(docs, F.lit(False)).collect()} == {("und", 0.0)}
    docs, _ = make(["a b", "c d e"])
    assert {r["lang_pred"] for r in crf.predict_languages(docs, F.lit(True)).collect()} == {"und"}
    assert crf.predict_languages(empty, F.lit(False)).collect() == []


def test_one_language(make):
    docs, _ = make(["a b", "c d e"], ["xx", "xx"])
    got = crf.predict_languages(docs, F.lit(False)).collect()
    assert {(r["lang_pred"], round(r["score"], 6)) for r in got} == {("xx", 1.0)}

import base64
import random

import corpus_pipeline as p
import numpy as np
import pytest
from conftest import DDL
from pyspark.sql import functions as F

from tracewaste.llm import crf

SF = "/root/testdata/sf0.01"
NEW = 10**9


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def clean(spark, documents):
    """Words of long clean documents by language."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    rows = documents.join(labels, "doc_id", "left_semi").orderBy("doc_id").collect()
    out = {}
    for r in rows:
        if len(r["text"].split()) >= 90:
            out.setdefault(r["lang"], []).append(r["text"].split()[:90])
    return out


def switched(clean, langs, size):
    """Texts of the languages in turn, ``size`` words at a time, the same number of each."""
    out = []
    for parts in zip(*(clean[lang] for lang in langs), strict=False):
        out.append(" ".join(w for i in range(0, 90, size) for part in parts for w in part[i : i + size]))
    return out[:10]


@pytest.mark.parametrize("size", [15, 90])
def test_clean_texts_of_several_languages_stay(spark, documents, clean, size):
    names = sorted(clean)
    some = [t for n in (2, 3, len(names)) for t in switched(clean, names[:n], size)]
    assert len(names) >= 3 and len(some) >= 15
    added = spark.createDataFrame([(NEW + i, t, None, None, None) for i, t in enumerate(some)], DDL)
    docs = documents.unionByName(added)
    labelled = crf.with_languages(docs).filter(F.col("row.doc_id") >= NEW).collect()
    assert any(r["score"] < 0.5 for r in labelled)
    got = {r["doc_id"] for r in p.language(spark, docs, SF).select("doc_id").collect()}
    assert {NEW + i for i in range(len(some))} <= got


POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są obdarzeni rozumem i sumieniem"
FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto"
RUSSIAN = "Все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью"


def foreign_texts():
    rng = random.Random(3)
    letters = [
        " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(rng.randint(3, 10))) for _ in range(80))
        for _ in range(20)
    ]
    encoded = [base64.b64encode(rng.randbytes(600)).decode() for _ in range(10)]
    lines = [" ".join(base64.b64encode(rng.randbytes(57)).decode() for _ in range(12)) for _ in range(10)]
    return [*letters, *encoded, *lines, POLISH, FINNISH, RUSSIAN, RUSSIAN.upper()]


def test_texts_of_no_learned_language_go(spark, documents):
    """Unlearned languages, random letters and encoded data are rejected at the stage's own threshold."""
    some = foreign_texts()
    docs = documents.unionByName(spark.createDataFrame([(NEW + i, t, None, None, None) for i, t in enumerate(some)], DDL))
    got = {r["doc_id"] for r in p.language(spark, docs, SF).select("doc_id").collect()}
    assert not {i for i in got if i >= NEW}
    assert len(got) > 0.98 * documents.count()


def test_texts_between_two_languages_go(spark, documents, clean):
    """Words with the beginning of one language and the end of another are of neither, whatever trigrams both have."""
    rng = random.Random(4)
    names = sorted(clean)
    long = {lang: [w for words in clean[lang] for w in words if len(w) >= 4] for lang in names}
    some = []
    for a, b in [(a, b) for a in names for b in names if a != b]:
        for _ in range(10):
            pairs = [(rng.choice(long[a]), rng.choice(long[b])) for _ in range(120)]
            some.append(" ".join(x[: len(x) // 2 + 1] + y[len(y) // 2 - 1 :] for x, y in pairs))
    docs = documents.unionByName(spark.createDataFrame([(NEW + i, t, None, None, None) for i, t in enumerate(some)], DDL))
    got = {r["doc_id"] for r in p.language(spark, docs, SF).select("doc_id").collect()}
    assert len(some) >= 60 and not {i for i in got if i >= NEW}
    assert len(got) > 0.98 * documents.count()


def test_many_languages_do_not_make_every_text_familiar():
    """Of 40 languages together nearly every trigram is known; a text still has to be of those it is labelled with."""
    rng = random.Random(6)

    def language():
        syllables = [rng.choice("bdfgklmnprstvz") + rng.choice("aeiouy") + rng.choice(["", *"lmnrst"]) for _ in range(40)]
        return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(150)]

    vocabularies = [language() for _ in range(40)]

    def text(*of):
        return " ".join(rng.choice(v) for v in of for _ in range(60)).encode()

    langs = [f"l{i}" for i in range(40) for _ in range(12)]
    field = crf.fit([text(vocabularies[i], vocabularies[i]) for i in range(40) for _ in range(12)], langs)
    own = [text(v) for v in vocabularies]
    switched = [text(v, w) for v, w in zip(vocabularies, vocabularies[1:], strict=False)]
    foreign = [text(language()) for _ in range(40)]
    natives = [crf._labelled(field, some)[4] for some in (own, switched, foreign)]
    assert natives[0].all() and natives[1].all() and not natives[2].any()


def test_a_language_of_one_row_lets_no_foreign_text_in(clean):
    """Words never seen are labelled with the first language; that one's single row does not make them familiar."""
    odd = b"qwy xwq yqx"
    known = [(" ".join(words).encode(), lang) for lang in sorted(clean) for words in clean[lang][:30]]
    field = crf.fit([odd, *(t for t, _ in known)], ["aa", *(lang for _, lang in known)])
    assert field.languages[0] == "aa" and field.least[0] > 0.3
    foreign = [t.encode() for t in foreign_texts() if " " in t]
    assert len(foreign) >= 30 and not crf._labelled(field, foreign)[4].any()
    assert crf._labelled(field, [odd, *(t for t, _ in known)])[4].all()


def test_few_labelled_rows_keep_all_texts():
    """Where no language has rows enough to tell what its texts have, none is foreign."""
    field = crf.fit([b"abc abd", b"xyz xyw", b"xyv xyu"], ["a", "b", "b"])
    assert field.least.tolist() == [0, 0]
    assert crf._labelled(field, [b"abq rst" * 9, b"xyq", b"12", b""])[4].tolist() == [True, True, False, False]


def test_known_trigrams_by_language_against_a_loop():
    texts = [b"abc", b"abc", b"abc a1c", b"a1c", b"", b"xyz"]
    words = crf.words_of(texts)
    labels = np.array([0, 0, 1, 0, 1, 2])
    got = crf.known_trigrams(words, words.lengths > 0, labels, 3)
    assert got.shape == (crf.BUCKETS, 3)

    def known(text, language):
        return got[crf.words_of([text]).trigrams, language].tolist()

    assert known(b"abc", 0) == [True] * 3
    # "abc" is in one window of a language with one, "a1c" in two windows of different ones.
    assert known(b"abc", 1) == [True] * 3 and known(b"abc", 2) == [False] * 3
    assert [known(b"a1c", i) for i in range(3)] == [[True] * 3] * 3
    assert known(b"xyz", 2) == [True] * 3 and known(b"xyz", 0) == [False] * 3


def test_familiar_shares_against_a_loop():
    texts = [b"abc abd", b"", b"xyz abc", "ÉTÉ été".encode(), b"..."]
    words = crf.words_of(texts)
    seen = crf.known_trigrams(words, np.array([True, False, True, True, False]))
    by_text = [set(words.trigrams[a:b].tolist()) for a, b in ((0, 6), (6, 12), (12, 22))]
    held = {t for s in by_text for t in s if sum(t in other for other in by_text) >= 2}
    assert set(np.flatnonzero(seen).tolist()) == held
    shares = crf.familiar_shares(seen, words)
    granted = crf.GRANTED_BYTES
    # "abc" is in two windows, the capitals are the same word, but in one window only.
    assert shares.tolist() == [(3 + granted) / (6 + granted), 1, (3 + granted) / (6 + granted), granted / (10 + granted), 1]


def test_no_labels(make, spark):
    docs, rows = make(["a b c", None, "", "...", "été 9", "12"], [None] * 6, clash=False)
    got = sorted(r["text"] for r in p.language(spark, docs, SF).collect())
    assert got == sorted(r[1] for r in rows if any(c.isalpha() for c in r[1] or ""))

import corpus_pipeline as p
import pytest
from conftest import texts
from test_packing import check
from test_rule_ledger import slow_failures, slow_measures
from test_simhash import slow_components, slow_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_language_keeps_clean_documents(spark, documents):
    kept = p.language(spark, documents, SF)
    assert kept.columns == COLUMNS
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    assert set(ids(labels)) <= set(ids(kept))


def test_language_rejects_texts_without_one(make, spark):
    docs, rows = make(texts(60), ["en"] * 80, clash=False)
    kept = p.language(spark, docs, SF).collect()
    assert all(any(c.isalpha() for c in r["text"]) for r in kept)


def test_quality_against_loops(make, spark, documents):
    some, rows = make(texts(100), clash=False)
    for docs, listed in ((some, rows), (documents, [tuple(r) for r in documents.collect()])):
        kept = p.quality(spark, docs, SF)
        assert kept.columns == COLUMNS
        wanted = sorted(str(r[:2]) for r in listed if not slow_failures(slow_measures(r[1])))
        assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == wanted


def test_quality_keeps_clean_documents(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    clean = documents.join(labels, "doc_id", "left_semi").collect()
    long = {r["doc_id"] for r in clean if len(r["text"].split()) >= 50}
    assert long and long <= set(ids(p.quality(spark, documents, SF)))


def test_one_document_of_each_group(make, spark, documents):
    some, rows = make(texts(100), clash=False)
    for docs, listed in ((some, rows), (documents, [tuple(r) for r in documents.collect()])):
        kept = p.near_duplicates(spark, docs, SF)
        assert kept.columns == COLUMNS
        prints = [slow_fingerprint(r[1]) for r in listed]
        roots = slow_components(set(prints))
        groups = {}
        for r, f in zip(listed, prints, strict=True):
            groups.setdefault(roots[f], []).append((r[0] is None, r[0] or 0))
        wanted = sorted(min(g) for g in groups.values())
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == wanted


def test_whole_pipeline(spark, documents):
    docs = documents
    for _, stage in p.STAGES[:-1]:
        docs = p.written(stage(spark, docs, SF), "t")
    got = p.run(spark, SF).collect()
    check(got, [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)
    assert 300 < docs.count() < 1000


def test_empty_table(spark, empty):
    for _, stage in p.STAGES:
        assert stage(spark, empty, SF).collect() == []

import hashlib
import random

import pytest
from conftest import texts

from tracewaste.llm import piece_table as p

ODD = ["<P>", "a<S>b", "x<M", "<<P", "<", ">", "P>", "🙂é́x" * 40, "\x00a\x00", "日本語" * 99, "é" * 2_000_000, "ab" * 1_500_000]


def slow(doc_id, text):
    """(n, form, prefix, middle, output) by string slices."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    text = text or ""
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, middle, last = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{last}<P>{first}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{first}<S>{last}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_against_slices(make):
    docs, rows = make(texts(80) + ODD)
    got = p.fim_digests(docs).collect()
    wanted = []
    for doc_id, text, *_ in rows:
        *facts, output = slow(doc_id, text)
        wanted.append((doc_id, *facts, sha(output), sha(text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_examples_and_texts_restored_from_them(make):
    docs, rows = make(texts(60) + ODD[:9])
    made = p.fim_examples(docs)
    got = p.restored_texts(made).collect()
    wanted = sorted(str((r[0], r[1], *slow(r[0], r[1]))) for r in rows)
    have = [(r["row"]["doc_id"], r["row"]["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got]
    assert sorted(map(str, have)) == wanted
    assert all(r["restored"] == (r["row"]["text"] or "") for r in got)


def test_null_outputs_stay_null(spark):
    rows = spark.createDataFrame([(None, "psm"), ("x", None), ("", "plain")], "output string, form string")
    assert [r["restored"] for r in p.restored_texts(rows).collect()] == [None, "x", ""]


@pytest.mark.parametrize("seed", range(30))
def test_descriptors(seed):
    """Cutting anywhere, again and again, loses nothing, and outputs spell what their descriptors say."""
    rng = random.Random(seed)
    text = "".join(rng.choice("ab<PSM>é🙂") for _ in range(rng.randint(1, 60))).encode()
    pieces = [(p.TEXT, 0, len(text))]
    for _ in range(5):
        head, tail = p.cut(pieces, rng.randint(0, len(text)))
        pieces = head + tail
        assert b"".join(p.streamed(pieces, text)) == text and p.piece_length(pieces) == len(text)
    if any(m in text for m in p.SENTINELS):
        return
    first, second = sorted(rng.choices(range(len(text) + 1), k=2))
    for form in p.ARRANGEMENTS:
        output = b"".join(p.streamed(p.arranged(pieces, first, second, form), text))
        assert len(output) == len(text) + 9
        assert b"".join(p.streamed(p.restored_pieces(output, form), output)) == text
        assert p.digest(p.arranged(pieces, first, second, form), text) == hashlib.sha256(output).hexdigest()


def test_code_points_over_blocks(monkeypatch):
    monkeypatch.setattr(p, "BLOCK", 7)
    text = "aé🙂日x" * 9
    data = text.encode()
    counts = p.code_points(data)
    assert sum(counts) == len(text)
    for n in range(len(text) + 1):
        assert p.byte_of(data, counts, n) == len(text[:n].encode())


def test_empty_table(empty):
    assert p.fim_digests(empty).collect() == []
    assert p.restored_texts(p.fim_examples(empty)).collect() == []

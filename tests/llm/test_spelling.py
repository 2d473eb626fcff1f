import random
import re
import zlib
from collections import Counter

import pytest
from conftest import texts

from tracewaste.llm import spelling as s

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans(s.CAPITALS, s.SMALL)


def slow_words(rows):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))  # noqa: B905
    if len(a) == len(b):
        return a != b and a[at + 1 :] == b[at + 1 :]
    return len(a) == len(b) + 1 and a[at + 1 :] == b[at:]


def slow_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else 0) for w, n in words.items())


def typos(n, alphabet="abé×", seed=2):
    """Texts of a few stems with edits anywhere, runs of equal letters among them, and odd separators."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 11))) for _ in range(12)] + ["aaaaaaaa", "bbbbbbb"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(1, 60)):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                i = rng.randint(0, len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :]])
            words.append(rng.choice([w, w.upper(), w]))
        out.append("".join(w + rng.choice([" ", "9", "_", "ā", "\n"]) for w in words))
    return out


def check(docs, rows):
    words = slow_words(rows)
    got = sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in s.spelling_variants(docs).collect())
    assert got == slow_variants(words)
    return got


def test_small_tries_against_all_pairs(make):
    docs, rows = make(typos(150) + texts(40))
    got = check(docs, rows)
    assert sum(r[4] for r in got) > 100 and any(r[1] for r in got)


@pytest.mark.parametrize("letters", [7, 9])
def test_words_deeper_than_the_trie(make, monkeypatch, letters):
    """The other way, for long words, meets the trie at any depth and gives the same neighbours."""
    monkeypatch.setattr(s, "TRIE_LETTERS", letters)
    docs, rows = make(typos(120, seed=4))
    check(docs, rows)


def test_very_long_words(make, monkeypatch):
    monkeypatch.setattr(s, "TRIE_LETTERS", 12)
    rng = random.Random(5)
    long = "".join(rng.choice("abc") for _ in range(3000))
    some = [long, long[:1500] + long[1501:], long[:2000] + "z" + long[2001:], "q" + long, "a" * 5000, "a" * 4999, "a" * 12, "a" * 13, "b" * 12]
    docs, rows = make([f"{w} {w.upper()}." for w in some])
    check(docs, rows)


def test_shortened_hashes():
    word = "abcab" * 30 + "ÿ"
    own, without = s.shortened_hashes(word)
    for i in range(len(word)):
        assert without[i] == s.shortened_hashes(word[:i] + word[i + 1 :])[0]
    assert own != without[0]


def test_forms_are_followed_to_the_last(spark):
    chain = [f"w{i}" for i in range(14)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)) + [("x", "w13")], "word string, form string")
    assert {r["word"]: r["root"] for r in s.roots_of(forms).collect()} == {w: "w13" for w in [*chain[:-1], "x"]}


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(rows, [(r["doc_id"], r["text"]) for r in rows.collect()])


def test_no_words(make, empty):
    assert s.spelling_variants(empty).collect() == []
    docs, _ = make(["short words only", None, "", "12345678 ________"])
    assert s.spelling_variants(docs).collect() == []

import re
from collections import Counter

from conftest import texts
from pyspark.sql import functions as F

from tracewaste.llm import rules


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + o for i, w in enumerate(windows) if often[w] > 1 for o in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
        sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7F]", w)) for w in words),
        sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*$", x)) for x in lines),
    )


MORE = ["x y z x y z x y z", "a b c a b", "l\nl\nm \nm\n\nl", "# $ | <>", "wait...\nso… \n…x\nend", "a\x0bb\x0cc\rd", "no space"]


def test_measures():
    for text in texts(80) + MORE:
        assert rules.measure((text or "").encode()) == slow_measures(text), text


def slow_failures(m):
    words, chars, symbols, lines, dups, repeats, letters, cut = m
    return {
        r
        for r, bad in {
            "few_words": words < 50,
            "repeated_words": 100 * repeats > 50 * words,
            "many_symbols": symbols > words,
            "short_words": chars < 2 * words,
            "long_words": chars > 20 * words,
            "repeated_lines": lines >= 4 and 2 * dups > lines,
            "few_letters": 10 * letters < 8 * words,
            "cut_lines": lines >= 4 and 10 * cut > 9 * lines,
        }.items()
        if bad
    }


def test_ledger_policies_and_ablations(make):
    docs, rows = make(texts(120) + MORE + ["q... \n" * 60, "1 2 3 " * 30, "w" * 30 + " " + "v" * 30])
    book = rules.ledger(docs).cache()
    failures = {r[0]: slow_failures(slow_measures(r[1])) for r in rows}
    for r in book.collect():
        assert {n for n, b in rules.BITS.items() if r["failed"] & b} == failures[r["doc_id"]]
    for version, policy in rules.POLICIES.items():
        kept = rules.apply_policy(book, version).collect()
        for r in kept:
            bad = failures[r["doc_id"]] & set(policy)
            assert r["kept"] == (not bad)
            assert r["sole_failure"] == (next(iter(bad)) if len(bad) == 1 else None)
        for r in rules.ablations(book, version).collect():
            bad = [failures[x[0]] & set(policy) for x in rows]
            assert r["failing"] == sum(r["rule"] in b for b in bad)
            assert r["kept"] == sum(not b for b in bad)
            assert r["kept_without"] == sum(not b - {r["rule"]} for b in bad)
    book.unpersist()


def test_query_columns(make):
    docs, rows = make([None, "", "a b", "word " * 60])
    got = {r["doc_id"]: r for r in rules.rule_verdicts(docs).collect()}
    assert (got[0]["base_failed"], got[0]["kept"], got[0]["n_words"]) == (True, False, 0)
    assert got[0]["sole_failure"] == "few_words"
    assert all(not r["kept"] for r in got.values() if r["base_failed"])


def test_empty_table(empty):
    assert rules.rule_verdicts(empty).collect() == []
    assert {tuple(r)[1:] for r in rules.ablations(rules.ledger(empty)).collect()} == {(0, 0, 0)}


def test_base_is_part_of_every_policy():
    assert all(set(rules.BASE) <= set(p) for p in rules.POLICIES.values())
    assert rules.POLICIES[rules.PRODUCTION] and F

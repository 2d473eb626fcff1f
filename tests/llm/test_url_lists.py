from datetime import date, timedelta

import pytest

from tracewaste.llm import url_lists as u

D = date(2024, 1, 1)


def day(n):
    return D + timedelta(days=n)


ENTRIES = [
    ("spam", "host", "a.example.com", True, day(5), 1),
    ("spam", "host", "a.example.com", True, day(7), 1),
    ("spam", "host", "a.example.com", False, day(10), 1),
    ("spam", "host", "a.example.com", False, day(11), 1),
    ("spam", "host", "a.example.com", True, day(20), 1),
    ("ads", "domain", "example.com", True, day(8), 1),
    ("ads", "domain", "example.com", False, day(9), 1),
    ("ads", "domain", "example.com", True, day(9), 1),
    ("bad", "url", "b.example.org/x?y=1", True, day(3), 1),
    ("bad", "url", None, True, day(3), 1),
    ("bad", "host", "b.example.org", None, day(3), 1),
    ("bad", "host", "b.example.org", False, day(1), 1),
    (None, "host", "b.example.org", True, day(1), 1),
]
URLS = [
    "http://a.example.com/1",
    "https://user@A.Example.com:8080/2#f",
    "http://x.a.example.com",
    "http://b.example.org/x?y=1#z",
    "https://b.example.org/x",
    "http://example.com",
    "not an address",
    "",
    None,
]


def brute_force(url, at):
    if not url or "://" not in url or at is None:
        return None, ""
    rest = url.split("://", 1)[1].split("#")[0]
    authority = rest.split("/")[0].split("?")[0]
    host = authority.split("@")[-1].split(":")[0].lower()
    address = host + rest[len(authority) :]
    labels = host.split(".")
    keys = {("url", address), ("host", host)}
    keys |= {("domain", ".".join(labels[i:])) for i in range(max(1, len(labels) - 1))}
    found = set()
    for name, kind, value in {e[:3] for e in ENTRIES if None not in e}:
        if (kind, value) in keys:
            past = [e for e in ENTRIES if e[:3] == (name, kind, value) and None not in e and e[4] <= at]
            if past:
                last = max(e[4] for e in past)
                if any(e[3] for e in past if e[4] == last):
                    found.add(name)
    return host, ",".join(sorted(found))


def test_against_brute_force(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, value string, listed boolean, since date, day int")
    rows = [(i * 100 + n, url, day(n)) for i, url in enumerate(URLS) for n in range(0, 25)]
    rows += [(None, URLS[0], day(6)), (5, URLS[0], None)] + rows[:30]
    captures = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, fetched_on date, host string")
    got = u.temporal_list_join(captures, entries).collect()
    wanted = [(p, url, at, *brute_force(url, at)) for p, url, at in rows]

    def key(x):
        return tuple(str(v) for v in x)

    fixed = [(p, url, at, u_host(url), lists, bool(lists)) for p, url, at, _, lists in wanted]
    assert sorted(map(tuple, got), key=key) == sorted(fixed, key=key)


def u_host(url):
    return brute_force(url, D)[0]


@pytest.mark.parametrize("which", ["captures", "entries"])
def test_empty_tables(spark, which):
    entries = spark.createDataFrame(
        ENTRIES if which == "captures" else [], "list string, kind string, value string, listed boolean, since date, day int"
    )
    rows = [] if which == "captures" else [(1, URLS[0], day(6))]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on date")
    got = u.temporal_list_join(captures, entries).collect()
    assert [r["blocked"] for r in got] == [False] * len(rows)


def test_no_python_in_the_plan(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, value string, listed boolean, since date, day int")
    captures = spark.createDataFrame([(1, URLS[0], D)], "page_id long, url string, fetched_on date")
    plan = u.temporal_list_join(captures, entries)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as further columns of a table they must not matter.
CLASHES = "fp long, block long, word string, shard int, slot long, piece long, kept boolean, u long, c long, row long"

WORDS = ["the", "Rain", "rain", "été", "naïve", "x", "of", "and", "9", "##", "日本", "end", "a|b", "CAT", "cat"]


def texts(n, seed=1):
    rng = random.Random(seed)
    out = [None, "", " \t\n", "one", "one two", "One TWO", "...", "— —", "\n\n", "a" * 5000, "é" * 300]
    while len(out) < n:
        size = rng.choice([3, 10, 60, 200])
        out.append(rng.choice([" ", "\n", "  "]).join(rng.choice(WORDS) for _ in range(size)))
    out += out[:20]  # repeated texts
    return out


@pytest.fixture
def make(spark):
    """Documents of the given texts, with repeated and null ids and with columns of clashing names."""

    def build(values, langs=None, clash=True):
        n = len(values)
        ids = list(range(n))
        if n > 4:
            ids[3] = None
        langs = langs or [["en", "fr", None][i % 3] for i in range(n)]
        rows = [(ids[i], values[i], langs[i], None if i % 5 == 0 else f"s{i % 3}", None) for i in range(n)]
        rows += rows[5:7]  # repeated rows
        extra = [(None,) * 10] * len(rows) if clash else [()] * len(rows)
        ddl = f"{DDL}, {CLASHES}" if clash else DDL
        return spark.createDataFrame([r + e for r, e in zip(rows, extra, strict=True)], ddl).repartition(3), rows

    return build


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DDL)

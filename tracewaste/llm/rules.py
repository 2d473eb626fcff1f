"""Quality rules as a ledger of bit masks.

Every rule is evaluated once: a document's row holds the measurements and one failure bit per rule. A
policy is a versioned mask of rules, so a new policy, and what dropping each of its rules would change,
are bitwise arithmetic on the ledger and never read a text again.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewaste.llm.tables import appended

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_letter_words",
    "n_ellipsis_lines",
)
MEASURES_TYPES = ", ".join(f"{m} long" for m in MEASURES)

#: A rule's bit is its place here; new rules go to the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "n_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "few_letters": "10 * n_letter_words < 8 * n_words",
    "cut_lines": "n_lines >= 4 AND 10 * n_ellipsis_lines > 9 * n_lines",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = ("few_words", "repeated_words")

#: Policies by version; a version once used is never changed.
POLICIES = {
    1: BASE,
    2: (*BASE, "many_symbols", "short_words", "long_words", "few_letters"),
    3: tuple(RULES),
}
PRODUCTION = 3

_SYMBOLS = b"#*$%&|<>"
_LETTERS = bytes(i for i in range(256) if not (65 <= i <= 90 or 97 <= i <= 122 or i >= 128))
_CONTINUED = bytes(range(0x80, 0xC0))


def _repeated(words: list[bytes]) -> int:
    """Words in three-word windows that the text has twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(words) + ids[1:], return_inverse=True)
    _, same, often = np.unique(pairs[:-1] * len(words) + ids[2:], return_inverse=True, return_counts=True)
    windows = often[same] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + n] |= windows
    return int(np.count_nonzero(covered))


def measure(text: bytes) -> tuple[int, ...]:
    """The measures of one text in the order of MEASURES."""
    words = text.split()
    if not words:
        return (0,) * len(MEASURES)
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    letters = sum(1 for w in words if w.translate(None, _LETTERS)) if joined.translate(None, _LETTERS) else 0
    return (
        len(words),
        len(joined.translate(None, _CONTINUED)),
        sum(map(joined.count, (_SYMBOLS[i : i + 1] for i in range(len(_SYMBOLS))))),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(words),
        letters,
        sum(1 for x in lines if x.rstrip().endswith((b"...", b"\xe2\x80\xa6"))) if b".." in text or b"\xe2" in text else 0,
    )


def measured(docs: DataFrame) -> DataFrame:
    """(row, measures, failed): whole rows of ``docs`` as a struct, with their ledger entries."""
    return appended(docs, "text", _append_measures, MEASURES_TYPES).withColumn("failed", failure_bits())


def _append_measures():
    def run(texts: list[bytes]):
        rows = np.array([measure(t) for t in texts], np.int64).reshape(-1, len(MEASURES))
        return [pa.array(rows[:, i]) for i in range(len(MEASURES))]

    return run


def failure_bits() -> Column:
    """One bit for each rule that a row of measures fails."""
    bits = F.lit(0).cast("long")
    for name, failed in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(BITS[name])).otherwise(0).cast("long"))
    return bits


def mask_of(rules) -> int:
    return sum(BITS[r] for r in rules)


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measures, failed) of every document: each rule evaluated once.

    Words lie between ASCII white space. A null or empty text has no words and fails `few_words` alone.
    Lines count if they have a word; copies are equal to the byte. Repeated rows have a row each, and
    further columns are left out.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return measured(slim).select("row.doc_id", *MEASURES, "failed")


def kept_by(rules, failed: Column | None = None) -> Column:
    """Whether a row passes all the given rules."""
    return (F.col("failed") if failed is None else failed).bitwiseAND(F.lit(mask_of(rules))) == 0


def apply_policy(rows: DataFrame, version: int = PRODUCTION) -> DataFrame:
    """The ledger with kept, policy and sole_failure: the one rule whose removal would keep the row, or null."""
    rules = POLICIES[version]
    failing = F.col("failed").bitwiseAND(F.lit(mask_of(rules)))
    sole = F.coalesce(*(F.when(failing == BITS[r], F.lit(r)) for r in rules))
    return rows.withColumns({"kept": kept_by(rules), "policy": F.lit(version), "sole_failure": sole})


def ablations(rows: DataFrame, version: int = PRODUCTION) -> DataFrame:
    """(rule, failing, kept, kept_without): what each rule of a policy rejects, and what its removal would keep.

    Rows are first counted by their failing bits, of which there are at most two to the power of the
    rules, so the texts' number does not matter after the first aggregation. An empty ledger counts 0.
    """
    rules = POLICIES[version]
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask_of(rules))).alias("failed")).agg(
        F.count("*").alias("n")
    )

    def rows_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    sums = patterns.agg(
        rows_if(kept_by(rules)).alias("kept"),
        *(rows_if(~kept_by([r])).alias(f"failing_{r}") for r in rules),
        *(rows_if(kept_by([x for x in rules if x != r])).alias(f"without_{r}") for r in rules),
    )
    listed = F.array(
        *(
            F.struct(
                F.lit(r).alias("rule"),
                F.col(f"failing_{r}").alias("failing"),
                F.col("kept"),
                F.col(f"without_{r}").alias("kept_without"),
            )
            for r in rules
        )
    )
    return sums.select(F.inline(listed))


def rule_verdicts(docs: DataFrame, version: int = PRODUCTION) -> DataFrame:
    """Measures, failure bits, the base verdict and the policy's of every document."""
    return apply_policy(ledger(docs), version).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~kept_by(BASE)).alias("base_failed"),
        "kept",
        "failed",
        "policy",
        "sole_failure",
    )

"""The rules as plain sequential loops over one session's calls, for comparison."""

from decimal import ROUND_HALF_EVEN, Decimal

SECOND = 1_000_000


def window(rows, i, span):
    """Rows of the same key up to and including ``i``, at most ``span`` back; rows are sorted."""
    return [r for r in rows[: i + 1] if r["at"] >= rows[i]["at"] - span]


def firings(rows, span, min_calls, mode, suppressed=False):
    """(row, count, burn) of each firing over one key's rows in (at, seq) order."""
    out, was_firing = [], False
    for i, row in enumerate(rows):
        inside = window(rows, i, span)
        fires = len(inside) >= min_calls and not (
            suppressed and any(r["flag"] for r in inside)
        )
        wanted = fires and not (
            (mode == "session" and out) or (mode == "edge" and was_firing)
        )
        if wanted:
            out.append((row, len(inside), sum(r["cost"] for r in inside[1:])))
        was_firing = fires
    return out


def by_key(rows, key):
    groups = {}
    for row in sorted(rows, key=lambda r: (r["at"], r["seq"])):
        groups.setdefault(key(row), []).append(row)
    return groups


def dollars(nanos):
    return (Decimal(nanos) / Decimal(10**9)).quantize(Decimal("0.000001"), ROUND_HALF_EVEN)

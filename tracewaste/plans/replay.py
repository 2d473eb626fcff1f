"""All calls through all rules."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame

from tracewaste.operators.catalog import price_table
from tracewaste.operators.rules import RULES, Rule, RuleContext


def replay(
    calls: DataFrame,
    catalog: DataFrame,
    project: str,
    config: dict[str, Any] | None = None,
    rules: dict[str, Rule] | None = None,
) -> DataFrame:
    """Events of every rule over every session.

    Sessions stay apart because every rule keys on ``session_id``. Each rule
    reads only its own columns of ``calls``, so pass a written table or a cheap
    projection rather than an unparsed source.
    """
    context = RuleContext(project, dict(config or {}))
    prices = price_table(catalog)
    chosen = RULES if rules is None else rules
    if not chosen:
        raise ValueError("replay needs at least one rule")
    return reduce(
        DataFrame.unionByName, [rule(calls, prices, context) for rule in chosen.values()]
    )

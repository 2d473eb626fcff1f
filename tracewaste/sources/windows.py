"""Time bounds on source records, per provider."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewaste.functions.times import iso_text, moment_literal, parse_iso, to_utc
from tracewaste.functions.values import at

# The record field each provider's time bound applies to.
TIME_FIELD = {"helicone": "created_at", "langfuse": "timestamp", "langsmith": "start_time"}


def _record_time(provider: str) -> Column:
    return parse_iso(iso_text(at(F.col("rec"), f"$.{TIME_FIELD[provider]}")))


def _whole_second(moment: datetime) -> Column:
    return moment_literal(to_utc(moment).replace(microsecond=0))


def within_bounds(
    records: DataFrame,
    provider: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Records inside the import window.

    The first format drops only records known to be older than ``since`` (to the
    microsecond) and takes no upper bound. The other two compare whole seconds,
    half-open, and drop records without a readable time. Records of a page without
    an ordinal stay, to be rejected with that reason.
    """
    if provider == "helicone":
        if until is not None:
            raise ValueError("this provider takes no upper time bound")
        if since is None:
            return records
        too_old = F.coalesce(_record_time(provider) < moment_literal(since), F.lit(False))
        return records.filter(~too_old)
    lost = F.col("page_idx").isNull()
    if since is not None:
        records = records.filter(lost | (_record_time(provider) >= _whole_second(since)))
    if until is not None:
        records = records.filter(lost | (_record_time(provider) < _whole_second(until)))
    return records


def top_level_runs(records: DataFrame) -> DataFrame:
    """Runs with ``execution_order = 1``; runs without the field pass."""
    order = F.try_variant_get("rec", "$.execution_order", "bigint")
    return records.filter(F.coalesce(order == 1, F.lit(True)))

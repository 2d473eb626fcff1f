"""Roll-ups of events: by type, in total, and the one-row summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rounded(amount: Column) -> Column:
    return F.bround(amount, 2).cast("decimal(18,2)")


def totals_by_type(events: DataFrame) -> DataFrame:
    """``(type, n, burn)``, unrounded, with a grand total row whose type is NULL.

    Counts, sums and the total come from one pass; the total is the sum of the
    unrounded amounts.
    """
    return events.rollup("type").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("estimated_burn"), F.lit(0)).cast("decimal(28,6)").alias("burn"),
    )


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("type").agg(F.count("*").alias("n"))


def burn_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("type").agg(_rounded(F.sum("estimated_burn")).alias("burn"))


def total_burn(events: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("estimated_burn"), F.lit(0))
    return events.agg(_rounded(total).alias("estimated_burn_total_usd"))


def summary_row(
    events: DataFrame,
    sessions: DataFrame,
    counts: Mapping[str, int],
    dry_run: bool,
    delivered: DataFrame | None = None,
) -> DataFrame:
    """The summary as one row.

    ``counts`` holds ``fetched_traces`` and ``pages_fetched``; ``sessions`` is the
    one-row session count; ``delivered`` holds ``accepted`` and ``rejected`` once
    responses to the delivered batches are known. The maps hold one entry per rule.
    """
    by_type = events.groupBy("type").agg(
        F.count("*").alias("n"), F.sum("estimated_burn").alias("burn")
    )
    fired = by_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fired_events"),
        F.map_from_entries(F.collect_list(F.struct("type", "n"))).alias("events_by_type"),
        F.map_from_entries(
            F.collect_list(F.struct(F.col("type"), _rounded(F.col("burn")).alias("burn")))
        ).alias("burn_by_type"),
        _rounded(F.coalesce(F.sum("burn"), F.lit(0))).alias("estimated_burn_total_usd"),
    )
    if delivered is None:
        accepted = rejected = F.lit(0).cast("bigint")
    else:
        accepted = delivered.select("accepted").scalar()
        rejected = delivered.select("rejected").scalar()
    return fired.select(
        F.lit(counts["fetched_traces"]).cast("bigint").alias("fetched_traces"),
        sessions.select("inferred_sessions").scalar().alias("inferred_sessions"),
        "fired_events",
        "events_by_type",
        "burn_by_type",
        "estimated_burn_total_usd",
        F.lit(counts["pages_fetched"]).cast("bigint").alias("pages_fetched"),
        accepted.alias("backfill_accepted"),
        rejected.alias("backfill_rejected"),
        F.lit(dry_run).alias("dry_run"),
    )

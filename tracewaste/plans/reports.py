"""Firing, savings and status reports over the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewaste.plans.summary import events_by_type, totals_by_type

# The rule types listed by name in the firing report.
NAMED_TYPES = ("tool_loop", "retry_storm", "model_misroute", "embedding_waste")


def firings_report(events: DataFrame) -> DataFrame:
    """``(position, type, firings)``: types in name order, then ``(others)``.

    The extra row sums the types outside the named ones, which are listed
    themselves as well; it is left out when there are none.
    """
    by_type = events_by_type(events)
    others = (
        by_type.filter(~F.col("type").isin(*NAMED_TYPES))
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
        .select(F.lit("(others)").alias("type"), "n", F.lit(1).alias("last"))
    )
    listed = by_type.withColumn("last", F.lit(0)).unionByName(others)
    return listed.orderBy("last", "type").select("type", F.col("n").alias("firings"))


def savings_report(events: DataFrame) -> DataFrame:
    """``(type, savings)``: amounts that round to more than zero, largest first, then ``total``."""
    totals = totals_by_type(events).select(
        F.coalesce("type", F.lit("total")).alias("type"),
        F.bround("burn", 2).cast("decimal(18,2)").alias("savings"),
        F.col("type").isNull().cast("int").alias("last"),
    )
    return (
        totals.filter("last = 1 OR savings > 0")
        .orderBy("last", F.desc("savings"), "type")
        .select("type", "savings")
    )


def status_report(summary: DataFrame) -> DataFrame:
    """``no_traces``, ``clean`` or ``leaks``, from the summary row."""
    status = (
        F.when(F.col("fired_events") > 0, F.lit("leaks"))
        .when(F.col("fetched_traces") == 0, F.lit("no_traces"))
        .otherwise(F.lit("clean"))
    )
    return summary.select(status.alias("status"), "fired_events", "dry_run")

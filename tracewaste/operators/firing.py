"""De-duplication of rule firings, and the event layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewaste.schemas import EVENTS, column_names

DEDUP_MODES = ("session", "edge", "none")
SDK_VERSION = "0.5.0"
NANOS = 1_000_000_000


def check_mode(mode: str) -> str:
    if mode not in DEDUP_MODES:
        raise ValueError(f"unknown dedup mode {mode!r}; expected one of {', '.join(DEDUP_MODES)}")
    return mode


def first_per_key(firings: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The earliest firing of each key.

    The rank filter lets Spark keep one row per key and task before any shuffle,
    so a key with very many firings does not gather in one task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return firings.withColumn("rank", rank).filter("rank = 1").drop("rank")


def rising_edges(firings: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Firings whose predecessor in the key did not fire.

    The predecessor is found by its ordinal, an equality join without hot keys.
    """
    followed = firings.select(*keys, (F.col(ordinal) + 1).alias(ordinal))
    return firings.join(followed, [*keys, ordinal], "left_anti")


def deduplicate(
    firings: DataFrame, keys: list[str], order: list[str], ordinal: str, mode: str
) -> DataFrame:
    check_mode(mode)
    if mode == "session":
        return first_per_key(firings, keys, order)
    if mode == "edge":
        return rising_edges(firings, keys, ordinal)
    return firings


def dollars(nanos: Column) -> Column:
    """Dollars to six places, half to even, from whole nano-dollars."""
    return F.bround(nanos.cast("decimal(20,0)") / F.lit(NANOS).cast("decimal(10,0)"), 6).cast(
        "decimal(18,6)"
    )


def as_events(
    firings: DataFrame,
    *,
    type: str,
    rule: str,
    confidence: float,
    action: str,
    project: str,
    evidence: dict[str, Column],
    burn_nanos: Column,
    raised_at: Column,
    src_seq: Column,
    sdk_version: str = SDK_VERSION,
) -> DataFrame:
    """Firings in the event layout; ``raised_at`` is the triggering call's own time.

    Evidence keeps its types: a number stays a number on the wire.
    """
    pairs = [part for k, v in evidence.items() for part in (F.lit(k), v.cast("variant"))]
    return firings.select(
        F.lit(type).alias("type"),
        F.lit(confidence).cast("double").alias("confidence"),
        F.lit(project).alias("project"),
        "session_id",
        F.lit(rule).alias("rule"),
        F.create_map(*pairs).alias("evidence"),
        dollars(burn_nanos).alias("estimated_burn"),
        F.lit(action).alias("suggested_action"),
        raised_at.alias("raised_at"),
        src_seq.alias("src_seq"),
        F.lit(sdk_version).alias("sdk_version"),
    ).select(*column_names(EVENTS))

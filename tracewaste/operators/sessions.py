"""Per-session figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_profile(calls: DataFrame) -> DataFrame:
    """One row per session. Counts and sums combine before the shuffle, so a session of
    any size reaches its reducer as one row per task."""
    return calls.groupBy("session_id").agg(
        F.count("*").alias("n_calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.min("timestamp").alias("first_call"),
        F.max("timestamp").alias("last_call"),
        F.min("src_seq").alias("first_seq"),
    )


def session_count(calls: DataFrame) -> DataFrame:
    """``inferred_sessions``: sessions with at least one valid call."""
    return calls.agg(F.count_distinct("session_id").alias("inferred_sessions"))


def session_rank(calls: DataFrame) -> DataFrame:
    """Arrival ordinal of each session's first valid call."""
    return calls.groupBy("session_id").agg(F.min("src_seq").alias("session_rank"))

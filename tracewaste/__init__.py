"""Waste analytics over model-call traces, on Spark."""

from tracewaste.plans.analyze import (
    Result,
    Source,
    analyze,
    analyze_helicone,
    analyze_langfuse,
    analyze_langsmith,
    analyze_many,
    delivered,
)
from tracewaste.plans.replay import replay

__all__ = [
    "Result",
    "Source",
    "analyze",
    "analyze_helicone",
    "analyze_langfuse",
    "analyze_langsmith",
    "analyze_many",
    "delivered",
    "replay",
]

"""The detection rules, each a function from calls to events.

A rule takes the calls, the price table of the model catalog and its context,
and returns events; a user's own rule is any function of that shape.
Partitioning by session id inside every key keeps sessions apart, so no session
is ever gathered as a whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewaste.functions.values import elements, is_present, is_string, text_at
from tracewaste.operators.catalog import with_cost
from tracewaste.operators.firing import (
    SDK_VERSION,
    as_events,
    check_mode,
    deduplicate,
)
from tracewaste.operators.trailing import AT, COST, FLAG, HOT_ROWS, SEQ, trailing_window
from tracewaste.session import cut_lineage

SECOND_US = 1_000_000

# Window lengths, rule names, confidences and actions of the event format;
# thresholds, the keyword list and the dedup mode are defaults that configuration overrides.
DEFAULTS: dict[str, Any] = {
    "dedup": "session",
    "hot_rows": HOT_ROWS,
    "tool_loop.window_seconds": 60,
    "tool_loop.min_calls": 4,
    "tool_loop.respect_user_facing": True,
    "retry_storm.window_seconds": 30,
    "retry_storm.min_calls": 3,
    "model_misroute.max_prompt_tokens": 200,
    "model_misroute.max_completion_tokens": 20,
    "model_misroute.keywords": [
        "classify",
        "classification",
        "categorize",
        "positive or negative",
        "yes or no",
        "sentiment",
    ],
}


@dataclass(frozen=True)
class RuleContext:
    project: str
    config: dict[str, Any] = field(default_factory=dict)
    sdk_version: str = SDK_VERSION

    def get(self, name: str) -> Any:
        return self.config.get(name, DEFAULTS.get(name))


Rule = Callable[[DataFrame, DataFrame, RuleContext], DataFrame]


def _window_row(*keys: Any, flag: Column) -> list[Any]:
    """The columns a trailing window needs, of priced calls."""
    return [
        "session_id",
        *keys,
        F.unix_micros("timestamp").alias(AT),
        F.col("src_seq").alias(SEQ),
        F.col("cost_nanos").alias(COST),
        flag.cast("int").alias(FLAG),
    ]


def _tool_rows(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """One row per call and distinct tool with arguments: a repeat inside a call counts once."""
    return (
        with_cost(calls.filter(F.size("tool_calls") > 0), prices)
        .withColumn("call_tool", F.explode(F.array_distinct("tool_calls")))
        .select(
            *_window_row(
                F.col("call_tool.name").alias("tool"),
                # The digest keeps long argument texts out of the shuffle and the sort.
                F.sha2("call_tool.arguments", 256).alias("arguments_digest"),
                flag=F.col("user_facing_output"),
            )
        )
    )


def _request_rows(calls: DataFrame, prices: DataFrame) -> DataFrame:
    return with_cost(calls, prices).select(*_window_row("request_hash", flag=F.lit(False)))


@dataclass(frozen=True)
class WindowedRule:
    """A rule that fires once enough equal calls fall into its trailing window."""

    name: str
    keys: list[str]
    rows: Callable[[DataFrame, DataFrame], DataFrame]
    evidence: str
    confidence: float
    action: str

    def span_us(self, context: RuleContext) -> int:
        return int(context.get(f"{self.name}.window_seconds") * SECOND_US)

    def firings(
        self, calls: DataFrame, prices: DataFrame, context: RuleContext
    ) -> list[DataFrame]:
        """Every firing with its window's measures, before de-duplication."""
        parts = trailing_window(
            self.rows(calls, prices),
            self.keys,
            self.span_us(context),
            context.get(f"{self.name}.min_calls"),
            context.get("hot_rows"),
        )
        # While a user-facing call is inside the window the rule stays silent.
        if context.get(f"{self.name}.respect_user_facing"):
            return [part.filter("flagged_window = 0") for part in parts]
        return parts

    def events(self, firings: DataFrame, context: RuleContext) -> DataFrame:
        return as_events(
            firings,
            type=self.name,
            rule=f"v0.{self.name}",
            confidence=self.confidence,
            action=self.action,
            project=context.project,
            evidence={self.evidence: F.col(self.evidence), "call_count": F.col("n_window")},
            burn_nanos=F.col("cost_window") - F.col("first_cost"),
            raised_at=F.timestamp_micros(AT),
            src_seq=F.col(SEQ),
            sdk_version=context.sdk_version,
        )

    def __call__(self, calls: DataFrame, prices: DataFrame, context: RuleContext) -> DataFrame:
        mode = check_mode(context.get("dedup"))
        return reduce(
            DataFrame.unionByName,
            [
                self.events(deduplicate(part, self.keys, [AT, SEQ], "ordinal", mode), context)
                for part in self.firings(calls, prices, context)
            ],
        )


# The same tool with the same arguments, again and again within a minute.
tool_loop = WindowedRule(
    name="tool_loop",
    keys=["session_id", "tool", "arguments_digest"],
    rows=_tool_rows,
    evidence="tool",
    confidence=0.85,
    action="pause_for_human_review",
)

# The same request repeated within half a minute.
retry_storm = WindowedRule(
    name="retry_storm",
    keys=["session_id", "request_hash"],
    rows=_request_rows,
    evidence="request_hash",
    confidence=0.9,
    action="add_backoff_or_check_upstream_health",
)


def _spoken_text(messages: Column) -> Column:
    """What all messages say, one after the other; content that is no text stays JSON."""
    return F.array_join(
        F.transform(
            elements(messages),
            lambda m: F.coalesce(text_at(m, "$.content"), F.try_variant_get(m, "$", "string")),
        ),
        "\n",
    )


def model_misroute(calls: DataFrame, prices: DataFrame, context: RuleContext) -> DataFrame:
    """A small classification-shaped call sent to a frontier model.

    Each such call fires on its own, so there is nothing to de-duplicate and no shuffle.
    """
    small = calls.filter(
        (F.col("prompt_tokens") <= context.get("model_misroute.max_prompt_tokens"))
        & (F.col("completion_tokens") <= context.get("model_misroute.max_completion_tokens"))
    )
    said = F.lower(_spoken_text(F.col("raw_request.messages")))
    keywords = context.get("model_misroute.keywords")
    classifies = reduce(lambda a, b: a | b, [said.contains(k.lower()) for k in keywords], F.lit(False))
    firings = with_cost(small, prices).filter(
        F.col("is_frontier") & F.col("alternative").isNotNull() & classifies
    )
    saved = F.col("cost_nanos") - (
        F.col("prompt_tokens") * F.col("alt_in_nanos")
        + F.col("completion_tokens") * F.col("alt_out_nanos")
    )
    return as_events(
        firings,
        type="model_misroute",
        rule="v0.model_misroute",
        confidence=0.7,
        action="route_to_smaller_model",
        project=context.project,
        evidence={
            "model": F.col("model"),
            "recommended_alternative": F.col("alternative"),
        },
        burn_nanos=saved,
        raised_at=F.col("timestamp"),
        src_seq=F.col("src_seq"),
        sdk_version=context.sdk_version,
    )


def _input_hash(item: Column) -> Column:
    """Digest of an element; a text never equals an object written as that text."""
    text = F.try_variant_get(item, "$", "string")
    kind = F.when(is_string(item), F.lit("text:")).otherwise(F.lit("json:"))
    return F.sha2(F.concat(kind, F.coalesce(text, F.lit("null"))), 256)


def embedded_inputs(calls: DataFrame) -> DataFrame:
    """One row per embedded element: its hash, position and share of the call.

    A list input is compared element by element; any other input is one element.
    """
    given = F.col("raw_request.input")
    items = F.coalesce(elements(given), F.array(given))
    return (
        calls.filter(F.col("method").endswith("embeddings.create") & is_present(given))
        .withColumn("items", items)
        .withColumn("n_items", F.size("items"))
        .select("*", F.posexplode("items").alias("pos", "item"))
        .withColumn("input_hash", _input_hash(F.col("item")))
        .drop("items", "item", "raw_request")
    )


def embedding_waste(calls: DataFrame, prices: DataFrame, context: RuleContext) -> DataFrame:
    """An element embedded again within the session.

    By default one event per repeated element, at its second occurrence; with
    dedup ``none`` every repeat is an event. Burn is the element's share of its call.
    """
    mode = check_mode(context.get("dedup"))
    keys, order = ["session_id", "input_hash"], ["timestamp", "src_seq", "pos"]
    rows = with_cost(embedded_inputs(calls), prices).select(
        *keys, *order, "cost_nanos", "n_items"
    )
    place = F.struct(*order)
    if mode == "none":
        # The minima combine before the shuffle. They are written, so that both sides of the join
        # are plain exchanges and a frequent element's rows may be split over tasks.
        rows = cut_lineage(rows)
        first = cut_lineage(rows.groupBy(*keys).agg(F.min(place).alias("first_place")))
        repeats = rows.join(first, keys).filter(place > F.col("first_place"))
    else:
        repeats = _second_per_key(rows, keys, order)
    return as_events(
        repeats,
        type="embedding_waste",
        rule="v0.embedding_waste",
        confidence=0.95,
        action="cache_embeddings",
        project=context.project,
        evidence={"input_hash": F.col("input_hash")},
        burn_nanos=F.expr("cost_nanos div n_items"),
        raised_at=F.col("timestamp"),
        src_seq=F.col("src_seq"),
        sdk_version=context.sdk_version,
    )


def _second_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    # ``rank <= 2`` is applied per task before the shuffle, so a hot key sends two rows a task.
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("rank", rank).filter("rank <= 2").filter("rank = 2").drop("rank")


RULES: dict[str, Rule] = {
    "tool_loop": tool_loop,
    "retry_storm": retry_storm,
    "model_misroute": model_misroute,
    "embedding_waste": embedding_waste,
}

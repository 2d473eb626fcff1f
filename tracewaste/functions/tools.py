"""Tool calls from model outputs, as ARRAY<STRUCT<name, arguments>>.

``arguments`` is JSON text with sorted object keys, so equal arguments are
equal text; an argument string keeps its quotes and so differs from an object.
The entry lists are bound as columns first and turned into calls afterwards,
so that each is read once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewaste.functions.values import (
    EMPTY_JSON,
    at,
    display_text_or,
    elements,
    is_object,
    text_at,
)

NO_TOOL_CALLS = "CAST(array() AS ARRAY<STRUCT<name: STRING, arguments: STRING>>)"


def tool_use_blocks(content: Column) -> Column:
    """The content blocks that call a tool."""
    return F.filter(elements(content), lambda block: text_at(block, "$.type") == "tool_use")


def tool_entries(listed: Column) -> Column:
    """The objects of a tool list."""
    return F.filter(elements(listed), is_object)


def _name(entry: Column, path: str) -> Column:
    # Only a name that is no plain text needs a look at its type.
    text = text_at(entry, path)
    return F.when(
        text.isNull() | text.isin("true", "false"), display_text_or(at(entry, path), "")
    ).otherwise(text)


def _arguments(entry: Column, *paths: str) -> Column:
    given = F.filter(
        F.array(*[F.to_json(at(entry, path)) for path in paths]),
        lambda text: ~text.isin(*EMPTY_JSON),
    )
    return F.coalesce(F.get(given, F.lit(0)), F.lit("{}"))


def _call(entry: Column, name: str, *arguments: str) -> Column:
    return F.struct(
        _name(entry, name).alias("name"), _arguments(entry, *arguments).alias("arguments")
    )


def _calls(entries: Column, name: str, *arguments: str) -> Column:
    """Calls of a bound entry list; NULL when it is empty, so that the next form is tried."""
    return F.when(F.size(entries) > 0, F.transform(entries, lambda e: _call(e, name, *arguments)))


def observation_tool_calls(blocks: Column, functions: Column, legacy: Column) -> Column:
    """Content blocks, then a function list, then a single legacy function call."""
    return F.coalesce(
        _calls(blocks, "$.name", "$.input"),
        _calls(functions, "$.function.name", "$.function.arguments"),
        F.when(is_object(legacy), F.array(_call(legacy, "$.name", "$.arguments"))),
        F.expr(NO_TOOL_CALLS),
    )


def run_tool_calls(message_tools: Column, blocks: Column, functions: Column) -> Column:
    """Tools of the first generation's message, its content blocks, then a function list."""
    return F.coalesce(
        _calls(message_tools, "$.name", "$.args", "$.arguments"),
        _calls(blocks, "$.name", "$.input"),
        _calls(functions, "$.function.name", "$.function.arguments"),
        F.expr(NO_TOOL_CALLS),
    )

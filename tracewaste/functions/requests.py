"""What was sent to the model: STRUCT<messages VARIANT, input VARIANT>.

All arguments are columns bound by the normaliser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewaste.functions.values import is_array, is_string, is_truthy, user_message


def _request(messages: Column, input_value: Column) -> Column:
    return F.struct(messages.alias("messages"), input_value.alias("input"))


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _wrapped_text(value: Column) -> Column:
    return F.when(is_string(value) & is_truthy(value), user_message(_text(value)))


def helicone_request(listed: Column, prompt: Column, body_input: Column, own_input: Column) -> Column:
    messages = (
        F.when(is_array(listed), listed)
        .when(is_array(prompt), prompt)
        .when(is_string(prompt), user_message(_text(prompt)))
        .otherwise(F.parse_json(F.lit("[]")))
    )
    # A key written as null still counts as given, so only a missing one falls through.
    return _request(messages, F.coalesce(body_input, own_input))


def langfuse_request(own: Column, nested: Column, nested_input: Column, outer: Column) -> Column:
    messages = F.coalesce(
        F.when(is_array(own), own).when(is_array(nested), nested),
        _wrapped_text(own),
        F.when(is_array(outer), outer),
        _wrapped_text(outer),
    )
    return _request(messages, nested_input)


def langsmith_request(listed: Column, given: Column) -> Column:
    messages = F.when(is_array(listed), listed).when(is_string(given), user_message(_text(given)))
    return _request(messages, F.when(~is_array(listed) & ~is_string(given), given))

"""Token counts from usage blocks, from columns bound by the normaliser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewaste.functions.values import display_text_or, is_present, whole_number


def or_zero(value: Column) -> Column:
    return F.coalesce(whole_number(value), F.lit(0).cast("bigint"))


def zero_unless(condition: Column, tokens: Column) -> Column:
    return F.when(condition, tokens).otherwise(F.lit(0).cast("bigint"))


def counted_in_tokens(unit: Column) -> Column:
    """True unless the usage block names another unit (characters, images, ...)."""
    return F.upper(display_text_or(unit, "TOKENS")).isin("", "TOKENS")


def run_tokens(prompt_top: Column, completion_top: Column, own_top: Column, nested: Column) -> Column:
    """Both top-level counts are used once either is present, otherwise the older nested ones."""
    return or_zero(
        F.when(is_present(prompt_top) | is_present(completion_top), own_top).otherwise(nested)
    )

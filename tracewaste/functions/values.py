"""Typed reads from loosely typed JSON held as VARIANT.

The source products never declare a schema, so each field is read with the
rules of a dynamically typed client: empty values (``0``, ``""``, ``[]``,
``{}``, ``false``, ``null``) fall through to the next candidate, a string
``"0"`` does not, and text is coerced to numbers only where the whole text is
a number. Everything is a native column expression.

Most helpers mention their argument several times, so pass them a column that
an earlier ``withColumns`` has bound, not a path lookup: Spark then reads each
field once per record and the generated code stays small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON texts of the values that count as empty.
EMPTY_JSON = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")

# Texts accepted as whole and as real numbers.
INTEGER_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
REAL_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)\s*$"


def at(value: Column, path: str) -> Column:
    """Sub-value at ``path``: SQL NULL when missing, a JSON null when written as null."""
    return F.try_variant_get(value, path, "variant")


def text_at(value: Column, path: str) -> Column:
    """Text form of the sub-value, whatever its type."""
    return F.try_variant_get(value, path, "string")


def elements(value: Column, path: str = "$") -> Column:
    """Array elements, or NULL when the value is anything but an array."""
    return F.try_variant_get(value, path, "array<variant>")


def is_object(value: Column) -> Column:
    # Casting to a struct without fields only inspects the type tag.
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def is_array(value: Column) -> Column:
    return elements(value).isNotNull()


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def is_present(value: Column) -> Column:
    """True unless the value is missing or JSON null."""
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))


def is_truthy(value: Column) -> Column:
    """True unless the value is missing or empty."""
    # Writing a string as JSON is costly, and most values are strings.
    return F.when(is_string(value), F.try_variant_get(value, "$", "string") != "").otherwise(
        F.coalesce(~F.to_json(value).isin(*EMPTY_JSON), F.lit(False))
    )


def is_filled_object(value: Column) -> Column:
    """True for an object with at least one key, without writing it as JSON."""
    return is_object(value) & (F.schema_of_variant(value) != "OBJECT<>")


def first_truthy(*candidates: Column) -> Column:
    """First candidate that is not empty, else NULL."""
    return F.coalesce(*[F.when(is_truthy(c), c) for c in candidates])


def display_text(value: Column) -> Column:
    """Text of a JSON value as a Python client prints it (objects and arrays stay JSON)."""
    plain = F.try_variant_get(value, "$", "string")
    return (
        F.when(F.is_variant_null(value), F.lit("None"))
        .when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(plain))
        .otherwise(plain)
    )


def display_text_or(value: Column, default: str) -> Column:
    """:func:`display_text`, with ``default`` only for a missing key."""
    return F.when(value.isNull(), F.lit(default)).otherwise(display_text(value))


def whole_number(value: Column) -> Column:
    """BIGINT value, truncated toward zero; NULL when the value is not a number."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(
        ~is_string(value), F.try_variant_get(value, "$", "bigint")
    ).when(
        text.rlike(INTEGER_TEXT),
        F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("bigint"),
    )


def real_number(value: Column) -> Column:
    """DOUBLE value; NULL when the value is not a number."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(
        ~is_string(value) | text.rlike(REAL_TEXT), F.try_variant_get(value, "$", "double")
    )


def first_match(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    """CASE over (condition, result) pairs, first match wins."""
    (condition, result), *rest = pairs
    return reduce(lambda case, p: case.when(*p), rest, F.when(condition, result)).otherwise(default)


def user_message(content: Column) -> Column:
    """A one-message conversation holding ``content``, as VARIANT."""
    return F.to_variant_object(
        F.array(F.struct(F.lit("user").alias("role"), content.alias("content")))
    )


def evaluated_once(df: DataFrame) -> DataFrame:
    """``df`` with its columns fixed at this point of the plan.

    A later filter on a derived column would otherwise be pushed below the
    projections with a second copy of the whole derivation, and long derivations
    would land in one generated method, too long for the JVM to compile.
    """
    return df.select(F.inline(F.array(F.struct("*"))))

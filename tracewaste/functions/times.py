"""Timestamp parsing and formatting."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewaste.functions.values import is_string

# Fixed patterns: extended ISO-8601 forms, from the most to the least common.
ISO_ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
ISO_LOCAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?$"
ISO_MINUTES = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def parse_iso(text: Column) -> Column:
    """UTC timestamp of a trimmed ISO-8601 text; NULL when it is not one.

    The shape is checked before the cast because a bare cast also takes a year
    alone and reads a time alone as today. A missing offset means UTC, whatever
    the session zone.
    """
    zone = F.when(F.length(text) == 16, F.lit("Z")).otherwise(F.substring(text, 17, 6))
    zoned = (
        F.when(text.rlike(ISO_ZONED), text)
        .when(text.rlike(ISO_LOCAL), F.concat(text, F.lit("Z")))
        .when(text.rlike(ISO_MINUTES), F.concat(F.substring(text, 1, 16), F.lit(":00"), zone))
        .when(text.rlike(ISO_DATE), F.concat(text, F.lit("T00:00:00Z")))
    )
    return zoned.try_cast("timestamp")


def iso_text(value: Column) -> Column:
    """The trimmed text of a JSON string; anything but a string gives NULL."""
    return F.when(
        is_string(value),
        F.btrim(F.try_variant_get(value, "$", "string"), F.lit(" \t\n\r\f\v")),
    )


def format_iso_seconds(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ``, sub-seconds dropped."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def format_iso_offset(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; the fraction appears only when it is not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(
        F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")
    ).otherwise(F.lit(""))
    return F.concat(whole, fraction, F.lit("+00:00"))


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds from start to end, never negative; 0 when there is no end."""
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
    return F.when(end.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), seconds * 1000.0))


def to_utc(moment: datetime) -> datetime:
    """Aware UTC datetime; a naive one is taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def parse_bound(text: str) -> datetime:
    """A user-given date bound: ``YYYY-MM-DD`` (midnight UTC) or an ISO-8601 datetime."""
    try:
        return to_utc(datetime.fromisoformat(text.strip().replace("Z", "+00:00")))
    except ValueError as exc:
        raise ValueError(f"not an ISO-8601 date or datetime: {text!r}") from exc


def moment_literal(moment: datetime) -> Column:
    """Timestamp literal that does not depend on the session zone."""
    return F.lit(to_utc(moment).isoformat()).cast("timestamp")

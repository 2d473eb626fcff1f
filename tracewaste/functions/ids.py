"""Session ids and request hashes, from columns bound by the normaliser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewaste.functions.values import display_text, display_text_or


def orphan_id(prefix: str, *parts: tuple[Column, str]) -> Column:
    """Stable id for a record that names neither a session nor itself."""
    pieces = [F.lit(f"{prefix}-orphan")] + [display_text_or(value, d) for value, d in parts]
    return F.concat_ws("-", *pieces)


def session_id(chosen: Column, orphan: Column) -> Column:
    """``chosen`` is the first non-empty id of the record, or NULL."""
    return F.coalesce(display_text(chosen), orphan)


def derived_request_hash(session: Column, record_id: Column) -> Column:
    """First 16 hex digits of SHA-256 over ``session|id``; ``record_id`` is NULL when empty."""
    own = F.coalesce(display_text(record_id), F.lit(""))
    return F.substring(F.sha2(F.concat(session, F.lit("|"), own), 256), 1, 16)

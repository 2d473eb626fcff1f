"""Ordered, fixed-size delivery batches of events."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewaste.functions.times import format_iso_offset
from tracewaste.schemas import EVENTS, column_names
from tracewaste.session import cut_lineage

CHUNK_SIZE = 50
# monotonically_increasing_id keeps the partition above this bit and the row below it.
ROW_BITS = 33


def wire_json(events: DataFrame) -> DataFrame:
    """Events with their wire JSON text in ``wire``."""
    wire = [c for c in column_names(EVENTS) if c not in ("src_seq", "raised_at")]
    fields = [F.col(c) for c in wire if c != "estimated_burn"]
    return events.withColumn(
        "wire",
        F.to_json(
            F.struct(
                *fields,
                F.col("estimated_burn").cast("double").alias("estimated_burn"),
                format_iso_offset(F.col("raised_at")).alias("raised_at"),
            )
        ),
    )


def in_delivery_order(events: DataFrame, ranks: DataFrame) -> DataFrame:
    """Events with ``ordinal``: sessions in first-seen order, then firing order, counted from 0.

    The rows are range-sorted across partitions and numbered inside each; only
    one count per partition is gathered to turn that into a global ordinal.
    """
    # Written ranks leave a plain exchange on both sides, so a large session may be split over tasks.
    placed = events.join(cut_lineage(ranks), "session_id", "left")
    sorted_rows = placed.orderBy(
        "session_rank", "session_id", "raised_at", "src_seq", "type", "evidence_key"
    )
    # Range borders come from a sample, so the numbering is written once and read back.
    numbered = cut_lineage(sorted_rows.withColumn("row_id", F.monotonically_increasing_id()))
    pid = F.shiftright("row_id", ROW_BITS)
    position = F.col("row_id").bitwiseAND(F.lit(2**ROW_BITS - 1))
    counts = numbered.groupBy(pid.alias("pid")).agg(F.count("*").alias("n"))
    # One row per partition of the sort.
    before = F.sum("n").over(W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("pid", F.coalesce(before, F.lit(0)).alias("offset"))
    return (
        numbered.withColumn("pid", pid)
        .join(F.broadcast(offsets), "pid")
        .withColumn("ordinal", F.col("offset") + position)
        .drop("pid", "offset", "row_id")
    )


def delivery_chunks(
    events: DataFrame, ranks: DataFrame, project: str, chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """``(chunk_id, project, n, body)`` with at most ``chunk_size`` events per body."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be > 0")
    # Only the text and what orders it goes through the sort.
    keyed = wire_json(events).select(
        "session_id",
        "raised_at",
        "src_seq",
        "type",
        F.to_json("evidence").alias("evidence_key"),
        "wire",
    )
    ordered = in_delivery_order(keyed, ranks)
    # A group never holds more than chunk_size rows.
    items = F.array_sort(F.collect_list(F.struct("ordinal", "wire")))
    texts = F.concat_ws(",", F.transform(items, lambda item: item["wire"]))
    return (
        ordered.withColumn("chunk_id", F.expr(f"ordinal div {int(chunk_size)}"))
        .groupBy("chunk_id")
        .agg(F.count("*").alias("n"), texts.alias("texts"))
        .select(
            "chunk_id",
            F.lit(project).alias("project"),
            "n",
            F.concat(
                F.lit(f'{{"project":{json.dumps(project)},"events":['), "texts", F.lit("]}")
            ).alias("body"),
        )
    )

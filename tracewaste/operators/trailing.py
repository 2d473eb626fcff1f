"""Exact trailing-window counts and sums per key, at any skew.

For every row the operator answers: how many rows of the same key, up to and
including this one in ``(at, seq)`` order, lie at most ``span`` microseconds
back, and what do they cost? A ``RANGE`` frame is not used, for two reasons: it
also takes in later rows with the same timestamp, and Spark re-reads the whole
frame for each row. Instead each row enters the window at its own time and
leaves it one microsecond after ``at + span``, which turns every measure into
a running sum over one sorted pass.

Ordinary keys take one hash shuffle. One sort in arrival order and a lag tell which rows fire at all: those
whose ``min_calls - 1``-th predecessor is not too old. Only the keys of such rows enter and leave windows,
in the same partitions. Keys of many rows are counted exactly and take a range shuffle on ``(key, time,
seq)`` instead, which cuts a single key into many partitions; each partition then starts from the totals
carried over from the earlier ones. Both paths return the same rows.

The rows are written once; the count of keys and the windows read the written table.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewaste.session import cut_lineage, written_rows

# A key below this many rows is left to a single task.
HOT_ROWS = 1_000_000
# Up to so many hot keys (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 100_000
HOT_PARTITIONS = 20_000

# The incoming row layout next to the key columns.
AT, SEQ, COST, FLAG = "at_us", "seq", "cost_nanos", "flag"
# The measures added to each row.
MEASURES = ["ordinal", "n_window", "cost_window", "flagged_window", "first_cost"]


def hot_key_hashes(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(h, n): hash and row count of the keys that hold at least ``hot_rows`` rows.

    The counts combine before the shuffle; no more than the rows divided by ``hot_rows`` remain, and
    they are written, not collected.
    """
    counted = rows.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n"))
    return cut_lineage(counted.filter(F.col("n") >= hot_rows))


def _with_exits(rows: DataFrame, span_us: int) -> DataFrame:
    """Each row twice: entering its window and leaving it. Leaving sorts first."""
    enter = F.struct(F.col(AT).alias("step_at"), F.lit(1).alias("step"))
    leave = F.struct((F.col(AT) + F.lit(span_us + 1)).alias("step_at"), F.lit(-1).alias("step"))
    return rows.withColumn("move", F.explode(F.array(leave, enter))).select(
        "*", "move.step_at", "move.step"
    ).drop("move")


def _deltas() -> dict:
    return {
        "ordinal": F.when(F.col("step") == 1, F.lit(1)).otherwise(F.lit(0)),
        "n_window": F.col("step"),
        "cost_window": F.col("step") * F.col(COST),
        "flagged_window": F.col("step") * F.col(FLAG),
    }


def _firing_keys(rows: DataFrame, keys: list[str], span_us: int, min_calls: int) -> DataFrame:
    """All rows of the keys that have a full window somewhere, in the partitions of the keys."""
    placed = rows.repartition(*keys)
    if min_calls <= 1:
        return placed
    arrival = W.partitionBy(*keys).orderBy(AT, SEQ)
    full = F.coalesce(F.col(AT) - F.lag(AT, min_calls - 1).over(arrival) <= span_us, F.lit(False))
    fires = F.max("full").over(W.partitionBy(*keys))
    return placed.withColumn("full", full).withColumn("fires", fires).filter("fires").drop("full", "fires")


def _ordinary_path(rows: DataFrame, keys: list[str], span_us: int, min_calls: int) -> DataFrame:
    arrival = W.partitionBy(*keys).orderBy(AT, SEQ)
    firing = _firing_keys(rows, keys, span_us, min_calls)
    moves = _with_exits(firing.withColumn("next_cost", F.lead(COST).over(arrival)), span_us)
    running = (
        W.partitionBy(*keys)
        .orderBy("step_at", "step", SEQ)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    measured = {name: F.sum(delta).over(running) for name, delta in _deltas().items()}
    # The oldest row still inside follows the one that left last.
    followed = F.last(F.when(F.col("step") == -1, F.col("next_cost")), ignorenulls=True)
    measured["first_cost"] = F.coalesce(followed.over(running), F.first(COST).over(running))
    return moves.withColumns(measured).filter("step = 1").drop("step_at", "step", "next_cost")


def _hot_path(rows: DataFrame, keys: list[str], span_us: int, partitions: int) -> DataFrame:
    order = ["step_at", "step", SEQ]
    # Partition borders come from a sample, so the split is written once and read back.
    split = cut_lineage(
        _with_exits(rows, span_us)
        .repartitionByRange(partitions, *keys, *order)
        .withColumn("pid", F.spark_partition_id())
    )
    deltas = _deltas()
    leaving = F.when(F.col("step") == -1, F.struct("step_at", SEQ, F.col(COST)))
    # A key fills consecutive partitions, so there are fewer totals than partitions plus hot keys.
    totals = split.groupBy("pid", *keys).agg(
        *[F.sum(d).alias(n) for n, d in deltas.items()], F.min(leaving).alias("next_out")
    )
    by_pid = W.partitionBy(*keys).orderBy("pid")
    earlier = by_pid.rowsBetween(W.unboundedPreceding, -1)
    # Later partitions are earlier ones in falling order; the nearest that lets a row out counts.
    later = W.partitionBy(*keys).orderBy(F.desc("pid")).rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(
        "pid",
        *keys,
        *[F.sum(n).over(earlier).alias(f"carried_{n}") for n in deltas],
        F.last(F.col(f"next_out.{COST}"), ignorenulls=True).over(later).alias("carried_out"),
    )
    within = W.partitionBy("pid", *keys).rowsBetween(W.unboundedPreceding, W.currentRow)
    onward, back = within.orderBy(*order), within.orderBy(*[F.desc(c) for c in order])
    # The oldest row inside a window is the next one to leave, here or in a later partition.
    next_out = F.last(F.when(F.col("step") == -1, F.col(COST)), ignorenulls=True).over(back)
    return (
        split.join(F.broadcast(carried), ["pid", *keys], "left")
        .withColumns(
            {
                n: F.sum(d).over(onward) + F.coalesce(F.col(f"carried_{n}"), F.lit(0))
                for n, d in deltas.items()
            }
        )
        .withColumn("first_cost", F.coalesce(next_out, F.col("carried_out")))
        .filter("step = 1")
        .drop("pid", "step_at", "step", "carried_out", *[f"carried_{n}" for n in deltas])
    )


def trailing_window(
    rows: DataFrame,
    keys: list[str],
    span_us: int,
    min_calls: int = 1,
    hot_rows: int = HOT_ROWS,
) -> list[DataFrame]:
    """``rows`` whose trailing window holds at least ``min_calls`` rows, with the window's measures.

    ``rows`` holds the ``keys``, ``at_us`` (BIGINT microseconds), ``seq`` (any number, unique
    per key and time), ``cost_nanos`` and ``flag`` (0 or 1). Returned as one frame
    for the ordinary keys and, where there are hot keys, a second one for those;
    no key is in both.
    """
    wanted = [*keys, AT, SEQ, COST, FLAG]
    rows, n_rows = written_rows(rows.select(*wanted), "window-rows")
    size = {"keys": 0}
    # Fewer rows than a hot key has cannot hold one.
    if n_rows >= hot_rows:
        hot = hot_key_hashes(rows, keys, hot_rows)
        size = hot.agg(F.count("*").alias("keys"), F.sum("n").alias("rows")).first()
    if not size["keys"]:
        measured = _ordinary_path(rows, keys, span_us, min_calls)
        return [measured.filter(F.col("n_window") >= min_calls).select(*wanted, *MEASURES)]
    listed = hot.select("h")
    if size["keys"] <= BROADCAST_KEYS:
        listed = F.broadcast(listed)
    partitions = min(max(2, ceil(2 * size["rows"] / hot_rows)), HOT_PARTITIONS)
    hashed = rows.withColumn("h", F.xxhash64(*keys))
    parts = [
        _ordinary_path(hashed.join(listed, "h", "left_anti").select(*wanted), keys, span_us, min_calls),
        _hot_path(hashed.join(listed, "h", "left_semi").select(*wanted), keys, span_us, partitions),
    ]
    return [p.filter(F.col("n_window") >= min_calls).select(*wanted, *MEASURES) for p in parts]

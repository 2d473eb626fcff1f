"""The windowed rules over a stream of calls, on Spark's own watermark, timers and state.

A rule's rows are grouped by a slice of time, ``SLICE_WINDOWS`` windows long, and one of ``BUCKETS`` parts of
the rule's keys. A row belongs to its own slice, and one that lies in the slice's last window also goes to the
next slice, where it only completes windows. So slices are independent: a key of very many calls is spread over
as many groups as its calls span slices, and a group's state holds the rows of one slice and one window of its
keys, no more. The state's calls and timers cost by group, not by key, and there are many more keys than groups.
When the watermark passes a slice's end, a timer evaluates the slice in time order, and its state goes.

The stream writes every firing. De-duplication reads those few rows as a batch, with the batch operator.
Calls behind the watermark are dropped by Spark, and those ahead of it still wait; both are in the table
of calls that the import has written, and the batch rules over that table tell what is to be added to the
stream's firings or taken back (:meth:`StreamingRule.corrections`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from tracewaste.functions.times import moment_literal
from tracewaste.operators.catalog import price_table
from tracewaste.operators.firing import first_per_key
from tracewaste.operators.rules import SECOND_US, RuleContext, WindowedRule
from tracewaste.operators.trailing import AT, COST, FLAG, SEQ
from tracewaste.sources.pages import ORDINAL

SLICE_WINDOWS = 4
#: Parts of the keys; a checkpoint holds its rows by them.
BUCKETS = 512
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The measures of a firing that need no more of the past than its window.
MEASURES = ["n_window", "cost_window", "flagged_window", "first_cost"]
# Built from types: a worker has no session that could parse a layout.
STORED = StructType([StructField("batch", BinaryType())])
_MEASURED = [(AT, pa.int64()), (SEQ, pa.decimal128(38, 0)), (COST, pa.int64()), (FLAG, pa.int32()), ("own", pa.bool_())]


def stored_schema(keys: list[str]) -> pa.Schema:
    """The layout of the batches of rows that a group's state holds."""
    return pa.schema([*((k, pa.string()) for k in keys), *_MEASURED])


def key_numbers(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """A number of each row's key; nulls are equal, as in a grouping."""
    number = np.zeros(len(rows), np.int64)
    for k in keys:
        own = pc.dictionary_encode(rows[k].combine_chunks(), null_encoding="encode")
        mixed = number * max(1, len(own.dictionary)) + own.indices.to_numpy()
        number = np.unique(mixed, return_inverse=True)[1]
    return number


def window_measures(rows: pa.Table, keys: list[str], span_us: int) -> pa.Table:
    """The rows of a group, those of a key together and in order, each with the measures of its trailing window.

    Its columns beside the keys are ``at_us``, ``seq``, ``cost_nanos`` and ``flag``; others stay. A null cost adds
    nothing, and the first cost is the first known one; both costs are null for a window without any.
    """
    rows = rows.append_column("key", pa.array(key_numbers(rows, keys)))
    rows = rows.sort_by([(c, "ascending") for c in ("key", AT, SEQ)])
    at, key = rows[AT].to_numpy(), rows["key"].to_numpy()
    # Places of times among the group's times, so that one search serves all keys.
    times, place = np.unique(at, return_inverse=True)
    oldest = np.searchsorted(times, at - span_us, side="left")
    wide = len(times) + 1
    first = np.searchsorted(key * wide + place, key * wide + oldest, side="left")
    here = np.arange(len(at))
    cost, flag = (pc.fill_null(rows[c], 0).to_numpy().astype(np.int64) for c in (COST, FLAG))
    known = rows[COST].is_valid().to_numpy()
    costs, flags, some = (np.concatenate([[0], np.cumsum(x)]) for x in (cost, flag, known))
    has = some[here + 1] > some[first]
    first_cost = cost[known][np.where(has, some[first], 0)] if known.any() else cost
    measured = {
        "n_window": here - first + 1,
        "cost_window": costs[here + 1] - costs[first],
        "flagged_window": flags[here + 1] - flags[first],
        "first_cost": first_cost,
    }
    for name, values in measured.items():
        rows = rows.append_column(name, pa.array(values, mask=~has if name in ("cost_window", "first_cost") else None))
    return rows.drop_columns(["key"])


class SliceProcessor(StatefulProcessor):
    """The rows of a slice and some keys until the watermark passes the slice's end, then their firings."""

    def __init__(self, columns: list[str], span_us: int, slice_us: int, min_calls: int):
        self.columns, self.span_us, self.slice_us, self.min_calls = columns, span_us, slice_us, min_calls

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", STORED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if not self.rows.exists():
            # A slice that only completes windows has a timer too, which clears it.
            self.handle.registerTimer((int(key[-1]) + 1) * self.slice_us // 1000)
        schema = stored_schema(self.columns)
        for part in rows:
            batch = pa.RecordBatch.from_pandas(part, schema, preserve_index=False)
            self.rows.appendValue((batch.serialize().to_pybytes(),))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        schema = stored_schema(self.columns)
        batches = [pa.ipc.read_record_batch(pa.py_buffer(batch), schema) for (batch,) in self.rows.get()]
        measured = window_measures(pa.Table.from_batches(batches, schema), self.columns, self.span_us)
        fired = measured.filter(pc.and_(measured["own"], pc.greater_equal(measured["n_window"], self.min_calls)))
        self.rows.clear()
        if len(fired):
            yield fired.select([*self.columns, AT, SEQ, COST, FLAG, *MEASURES]).to_pandas(integer_object_nulls=True)

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class StreamingRule:
    """One windowed rule over a stream of calls; firings go to ``<folder>/firings-<rule>``.

    De-duplication is ``session`` or ``none``. Calls that carry ``ingest_time`` had no time of their own:
    they would push the watermark past all others, so they are left to the corrections.
    """

    rule: WindowedRule
    folder: str
    catalog: DataFrame
    project: str
    delay_seconds: float
    config: dict[str, Any] = field(default_factory=dict)
    ingest_time: datetime | None = None

    def __post_init__(self) -> None:
        if self._context().get("dedup") not in ("session", "none"):
            raise ValueError("a stream de-duplicates per session or not at all")

    def _context(self) -> RuleContext:
        return RuleContext(self.project, self.config)

    def _rows(self, calls: DataFrame) -> DataFrame:
        timed = calls.filter("timestamp IS NOT NULL")
        if self.ingest_time is not None:
            timed = timed.filter(F.col("timestamp") != moment_literal(self.ingest_time))
        return self.rule.rows(timed, price_table(self.catalog))

    def fired(self, calls: DataFrame) -> DataFrame:
        """The firings of a stream of calls, once the watermark has passed them."""
        context, keys = self._context(), self.rule.keys
        span = self.rule.span_us(context)
        length = SLICE_WINDOWS * span
        own = F.expr(f"{AT} div {length}")
        rows = self._rows(calls).withColumn(SEQ, F.col(SEQ).cast(ORDINAL))
        slices = F.when(
            F.col(AT) >= (own + 1) * length - span,
            F.array(F.struct(own.alias("slice"), F.lit(True).alias("own")), F.struct((own + 1).alias("slice"), F.lit(False).alias("own"))),
        ).otherwise(F.array(F.struct(own.alias("slice"), F.lit(True).alias("own"))))
        sliced = (
            rows.withColumn("at", F.timestamp_micros(AT))
            .withWatermark("at", f"{int(self.delay_seconds * 1000)} milliseconds")
            .withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
            .select("bucket", *keys, AT, SEQ, COST, FLAG, "at", F.explode(slices).alias("in"))
            .select("bucket", *keys, AT, SEQ, COST, FLAG, "at", "in.slice", "in.own")
        )
        measures = ", ".join(f"{m} BIGINT" for m in MEASURES)
        layout = ", ".join(f"{k} STRING" for k in keys)
        layout = f"{layout}, {AT} BIGINT, {SEQ} DECIMAL(38,0), {COST} BIGINT, {FLAG} INT, {measures}"
        processor = SliceProcessor(keys, span, length, context.get(f"{self.rule.name}.min_calls"))
        fired = sliced.groupBy("bucket", "slice").transformWithStateInPandas(
            processor, StructType.fromDDL(layout), outputMode="append", timeMode="EventTime"
        )
        return self._spoken(fired)

    def _spoken(self, firings: DataFrame) -> DataFrame:
        if self._context().get(f"{self.rule.name}.respect_user_facing"):
            return firings.filter("flagged_window = 0")
        return firings

    def start(self, calls: DataFrame, **trigger: Any) -> StreamingQuery:
        """Start the rule over a stream of calls; by default all calls that are there now."""
        calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        return (
            self.fired(calls)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{self.folder}/checkpoint-{self.rule.name}")
            .trigger(**(trigger or {"availableNow": True}))
            .start(f"{self.folder}/firings-{self.rule.name}")
        )

    def firings(self, spark: SparkSession) -> DataFrame:
        """Every firing the stream has written."""
        return spark.read.parquet(f"{self.folder}/firings-{self.rule.name}")

    def _events(self, firings: DataFrame) -> DataFrame:
        if self._context().get("dedup") == "session":
            firings = first_per_key(firings, self.rule.keys, [AT, SEQ])
        return self.rule.events(firings, self._context())

    def events(self, spark: SparkSession) -> DataFrame:
        """Events of what the stream has written."""
        return self._events(self.firings(spark))

    def _batch_firings(self, calls: DataFrame) -> DataFrame:
        parts = self.rule.firings(calls, price_table(self.catalog), self._context())
        return reduce(DataFrame.unionByName, parts).select(*self.rule.keys, AT, SEQ, COST, FLAG, *MEASURES)

    def corrections(self, calls: DataFrame) -> DataFrame:
        """(change, ...firing): what ``calls``, the written table, adds to the stream's firings or takes back.

        Late calls and those that still wait add firings; a late call can also change a window that has
        fired: the old firing is dropped and the new one added.
        """
        truth, written = self._batch_firings(calls), self.firings(calls.sparkSession)
        columns = truth.columns
        written = written.select(*(F.col(c).cast(truth.schema[c].dataType).alias(c) for c in columns))
        add = truth.exceptAll(written).withColumn("change", F.lit("add"))
        drop = written.exceptAll(truth).withColumn("change", F.lit("drop"))
        return add.unionByName(drop).select("change", *columns)

    def corrected_events(self, calls: DataFrame) -> DataFrame:
        """Events of the stream's firings with the corrections applied; those of the batch rules."""
        changes = self.corrections(calls)
        columns = [c for c in changes.columns if c != "change"]
        written = self.firings(calls.sparkSession).select(*columns)
        kept = written.exceptAll(changes.filter("change = 'drop'").select(*columns))
        return self._events(kept.unionByName(changes.filter("change = 'add'").select(*columns)))

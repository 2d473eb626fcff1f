"""Reading the given tables, intermediate tables in the shared folder, and words of a text."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewaste.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back; a lost executor costs a re-read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def binary_text(text: Column) -> Column:
    """The UTF-8 bytes of a text, a null text being empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


#: Bytes of texts turned into Python objects at a time.
PART_BYTES = 4 << 20


def by_bytes(texts: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """(offset, length) of neighbouring rows whose texts hold about ``limit`` bytes together; a text is never cut."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, stop - at
        at = stop


def give_back() -> None:
    """Return freed memory to the machine, so that a kept worker does not hold the most it ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def appended(df: DataFrame, text: str, make, types: str) -> DataFrame:
    """``df``'s rows as one struct column ``row``, and what ``make()(texts)`` says of each one's text.

    ``make()`` is called once a task and gives a function from a list of texts (bytes, a null text being
    empty) to Arrow arrays of the named ``types``. The struct keeps clashing names apart; the text is read
    from it, not sent twice, and a few megabytes of texts are Python objects at a time.
    """
    whole = df.select(F.struct("*").alias("row"))
    place = df.columns.index(text)
    names = ["row", *(t.split()[0] for t in types.split(", "))]

    def run(batches):
        say = make()
        for batch in batches:
            rows = batch.column(0)
            texts = rows.field(place).cast(pa.binary())
            for at, n in by_bytes(texts):
                some = [t or b"" for t in texts.slice(at, n).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.slice(at, n), *say(some)], names=names)
        give_back()

    return whole.mapInArrow(run, f"row {whole.schema['row'].dataType.simpleString()}, {types}")


def ragged(parts: list[np.ndarray], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated values and the length of each part."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else np.zeros(0)).astype(dtype, copy=False), lengths


class Remembered:
    """Answers for byte strings, kept in two generations of ``limit`` / 2 bytes; for caches only.

    When the newer one is full the older one goes, so the limit holds whatever the strings' lengths.
    """

    #: Bytes of an entry beside its key's and value's, about.
    ENTRY = 170

    def __init__(self, limit: int):
        self.limit, self.size = limit // 2, 0
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def of(self, lists: list[list[bytes]], answer) -> dict[bytes, bytes]:
        """A table that holds all listed strings; ``answer`` gets those not known, each once."""
        known, older = self.new, self.old
        missing = {k for some in lists for k in some if k not in known}
        if not missing:
            return known
        found = {k: older[k] for k in missing if k in older} if older else {}
        if len(found) < len(missing):
            found |= answer([k for k in missing if k not in found])
        size = sum(map(len, found)) + sum(map(len, found.values())) + self.ENTRY * len(found)
        if self.size + size <= self.limit:
            known |= found
            self.size += size
            return known
        self.old, self.new, self.size = known, found, size
        if size > self.limit:
            self.new, self.size = {}, 0
        return known | found


def once_per_worker(key: str, make):
    """``make()``, kept for the tasks to come of the same Python worker; for caches only.

    A worker keeps one thing: what an earlier stage kept under another key goes.
    """
    held = sys.modules.setdefault("_tracewaste_worker", types.ModuleType("_tracewaste_worker")).__dict__
    held = held.setdefault("held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def row_number(partition: int) -> Iterator[int]:
    """Numbers no other task gives out: the partition in the high bits, a counter below."""
    n = partition << 33
    while True:
        yield n
        n += 1

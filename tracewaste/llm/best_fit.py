"""Packing by best-fit decreasing over all documents at once.

Every document is a row of ids with an end id; one longer than a sequence is cut into full pieces and a
rest, no other is cut. Pieces are placed by falling length, each into the open sequence with the least
room that still holds it. Lengths and rooms are whole numbers up to the capacity, so pieces of one
length are alike, and so are sequences of one room. The placing therefore needs only how many pieces
there are of each length, at most ``capacity`` numbers at any corpus size: a segment tree over the rooms
finds the tightest open one in logarithmic time, and a whole run of equal pieces moves at once. What
comes out is what best-fit decreasing gives piece by piece, over the whole corpus and not by groups.

The runs are then looked up by each piece's rank within its length. Ranks are counted inside the tasks
that cut the pieces, and one count a task and length places them in the whole; no length is gathered.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewaste.llm.packing import WordEncoder
from tracewaste.llm.tables import binary_text, by_bytes, give_back, once_per_worker, written

SEQUENCE_TOKENS = 4_096
END = 1
#: Bits of a rank beside the length in a search key.
RANK_BITS = 44
_CUT = pa.schema(
    [
        ("task", pa.int32()),
        ("nth", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_CUT_DDL = "task int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenRooms:
    """A segment tree over rooms 0 to ``capacity``; each node counts the open sequences below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, room: int, sequences: int) -> None:
        at = room + self.size
        while at:
            self.open[at] += sequences
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of ``length`` or more that an open sequence has."""
        at = length + self.size
        if not self.open[at]:
            while at % 2 or not self.open[at + 1]:
                at //= 2
                if at <= 1:
                    return None
            at += 1
            while at < self.size:
                at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


@dataclass(frozen=True)
class Runs:
    """Runs of equal pieces, by rising (length, first rank); one row each.

    ``each`` pieces of a run go into one sequence, from ``offset`` on, then the next sequence follows.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of the given lengths and ranks."""
        keys = (self.length << RANK_BITS) + self.first
        run = np.searchsorted(keys, (length << RANK_BITS) + rank, side="right") - 1
        past = rank - self.first[run]
        each = self.each[run]
        return self.sequence[run] + past // each, self.offset[run] + past % each * length


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Runs:
    """Places ``counts[length]`` pieces of each length, 1 to ``capacity``, into sequences.

    Every length opens and splits at most four intervals of sequences, and a sequence takes pieces of at
    most sqrt(2 * capacity) lengths, so there are no more than 4 * capacity * sqrt(2 * capacity) runs,
    however many pieces there are.
    """
    rooms = OpenRooms(capacity)
    held: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(room: int, sequence: int, n: int) -> None:
        if n:
            held[room].append((sequence, n))
            rooms.add(room, n)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                room = capacity
                n = -(-left // (capacity // length))
                put(room, opened, n)
                opened += n
            each = room // length
            sequence, n = held[room].pop()
            rooms.add(room, -n)
            full = min(n, left // each)
            if full:
                runs.append((length, rank, sequence, each, capacity - room))
                put(room - each * length, sequence, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:
                # The next one takes what is left, fewer than a full sequence takes.
                runs.append((length, rank, sequence + full, each, capacity - room))
                put(room - left * length, sequence + full, 1)
                left, full = 0, full + 1
            put(room, sequence + full, n - full)
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 5).T
    return Runs(*(np.ascontiguousarray(c) for c in columns), opened)


def _cut(tokenizer_path: str, end: int, capacity: int):
    closing = np.array([end], "<u4").tobytes()

    def run(batches):
        encoder = once_per_worker(f"words {tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for i, n in by_bytes(batch.column(1)):
                ids, texts = (batch.column(c).slice(i, n).to_pylist() for c in (0, 1))
                for doc_id, encoded in zip(ids, encoder.encode(texts), strict=True):
                    encoded += closing
                    for piece, at in enumerate(range(0, len(encoded), 4 * capacity)):
                        part = encoded[at : at + 4 * capacity]
                        length = len(part) // 4
                        rows.append((task, seen[length], doc_id, piece, at // 4, length, zlib.crc32(part)))
                        seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(_CUT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _CUT, strict=True)], schema=_CUT
            )
        give_back()

    return run


def cut_documents(docs: DataFrame, tokenizer_path: str, end: int = END, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Each document's pieces with their rank ``nth`` among those of their length in the task, written once.

    A null text has the end id alone. Ids are counted and summed, not kept.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text(F.col("text")).alias("text"))
    return written(slim.mapInArrow(_cut(tokenizer_path, end, capacity), _CUT_DDL), "best-fit-pieces")


def _place(runs):
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rank = table["nth"].to_numpy() + table["before"].to_numpy()
            sequence, offset = runs.value.places(table["length"].to_numpy(), rank)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            arrays = [table[n].combine_chunks() for n in names]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def packed(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` of cut_documents with sequence_id and offset, by best-fit decreasing over all of them.

    Pieces of equal length change places freely, so ties between documents do not matter; every piece
    is kept, repeated ones too. At most ``capacity`` counts reach the driver, and what is broadcast is
    bounded by the capacity alone (see best_fit_decreasing), 60 MB at 4,096 and a few hundred KB in use.
    """
    spark = pieces.sparkSession
    listed = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = written(
        listed.select("task", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")),
        "best-fit-ranks",
    )
    counts = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(best_fit_decreasing(counts, capacity))
    ranked = pieces.join(before.drop("n"), ["task", "length"])
    return ranked.mapInArrow(_place(runs), PACKED_DDL)


def best_fit_documents(docs: DataFrame, tokenizer_path: str, end: int = END, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Packs all documents; a null or empty text is a piece of the end id alone.

    A text of any length is encoded whole and cut into full pieces and a rest. Null and repeated ids are
    kept apart, each row having pieces of its own; an empty table gives no rows; further columns, also
    such with names used here, are left out.
    """
    return packed(cut_documents(docs, tokenizer_path, end, capacity), capacity)

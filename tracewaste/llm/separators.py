"""Token counts of documents in flat token files without an index.

A file is a run of ids in which an end-of-document id closes each document. Blocks are cut at fixed
places, whatever document they fall in, and are searched on their own, vectorised. What a block cannot
know, where the document open at its start began and how many documents came before, comes from a prefix
scan over the blocks' totals: within runs of ``RUN_BLOCKS`` blocks first, then over the runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewaste.llm.tables import binary_text, written

BLOCK_TOKENS = 65_536
RUN_BLOCKS = 1_024
FLAT_DDL = "file string, block long, ids binary, ordinal long, doc_id long"
_SCAN_DDL = "file string, block long, size long, ends array<int>, lengths array<int>"


def _flatten(tokenizer, end: int, dtype: str, block_tokens: int):
    """Writes documents as flat blocks of ids, and beside them the order of the documents."""

    def run(batches):
        encode = tokenizer()
        file = str(TaskContext.get().partitionId())
        held, size, block, ordinal = [], 0, 0, 0

        def rows(blocks, first, ids, numbers):
            n, m = len(blocks), len(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * (n + m)),
                    pa.array([*range(first, first + n), *[None] * m], pa.int64()),
                    pa.array([*(b.tobytes() for b in blocks), *[None] * m], pa.binary()),
                    pa.array([None] * n + numbers, pa.int64()),
                    pa.array([None] * n + ids, pa.int64()),
                ],
                names=["file", "block", "ids", "ordinal", "doc_id"],
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            yield rows([], 0, ids, list(range(ordinal, ordinal + len(ids))))
            ordinal += len(ids)
            for text in batch.column(1).to_pylist():
                held.append(np.array([*encode(text.decode("utf-8", "replace")), end], dtype))
                size += len(held[-1])
                if size >= 16 * block_tokens:
                    flat = np.concatenate(held)
                    full = size // block_tokens
                    yield rows(np.split(flat[: full * block_tokens], full), block, [], [])
                    block += full
                    held, size = [flat[full * block_tokens :]], size - full * block_tokens
        if size:
            flat = np.concatenate(held)
            cuts = list(range(block_tokens, size, block_tokens))
            yield rows(np.split(flat, cuts), block, [], [])

    return run


def flat_token_files(
    docs: DataFrame, tokenizer, end: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """(file, block, ids) and (file, ordinal, doc_id): each source partition as one flat file.

    ``tokenizer()`` makes, in a task, a function from a text to its ids, none of which may be ``end``.
    A null text is an empty one. Both tables are written in one pass to the shared folder.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text(F.col("text")).alias("text"))
    both = written(slim.mapInArrow(_flatten(tokenizer, end, dtype, block_tokens), FLAT_DDL), "flat-tokens")
    blocks = both.filter("ids IS NOT NULL").select("file", "block", "ids")
    return blocks, both.filter("ordinal IS NOT NULL").select("file", "ordinal", "doc_id")


def read_token_files(spark: SparkSession, path: str, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, ids) of the files under ``path``, each below 2 GB; trailing bytes of part of an id are left out."""
    step = np.dtype(dtype).itemsize * block_tokens

    def cut(batches):
        for batch in batches:
            for file, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                content = content[: len(content) // np.dtype(dtype).itemsize * np.dtype(dtype).itemsize]
                parts = [content[i : i + step] for i in range(0, len(content), step)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int64()),
                     pa.array(parts, pa.binary())],
                    names=["file", "block", "ids"],
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(cut, "file string, block long, ids binary")


def _scan(end: int, dtype: str):
    def run(batches):
        for batch in batches:
            sizes, ends, lengths = [], [], []
            for content in batch.column(2).to_pylist():
                ids = np.frombuffer(content, dtype)
                at = np.flatnonzero(ids == end).astype(np.int32)
                sizes.append(len(ids))
                ends.append(at)
                lengths.append(np.diff(at, prepend=np.int32(-1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(ends, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32()))],
                names=["file", "block", "size", "ends", "lengths"],
            )

    return run


def separator_scan(blocks: DataFrame, end: int, dtype: str = "<u2") -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in flat token files.

    ``blocks`` has file, block (numbered from 0 without gaps) and ids, the bytes of whole ids. ``start``
    is the document's first token in its file; ``n_tokens`` does not count the end id. A document may
    span any number of blocks. Tokens after a file's last end id are a last document that is not closed.
    Empty blocks and files have no documents; rows with a null are left out.
    """
    scanned = written(
        blocks.select(F.col("file").cast("string").alias("file"), "block", "ids")
        .dropna()
        .mapInArrow(_scan(end, dtype), _SCAN_DDL),
        "separators",
    )
    stats = scanned.select(
        "file",
        "block",
        F.floor(F.col("block") / RUN_BLOCKS).alias("run"),
        "size",
        F.size("ends").cast("long").alias("docs"),
        F.try_element_at("ends", F.lit(-1)).cast("long").alias("last"),
    ).withColumn("last", F.when(F.col("docs") > 0, F.col("last")))
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    local = stats.withColumn("tokens_in_run", F.coalesce(F.sum("size").over(inside), zero)).withColumn(
        "docs_in_run", F.coalesce(F.sum("docs").over(inside), zero)
    )
    local = local.withColumn("opened", F.col("tokens_in_run") + F.col("last") + 1).withColumn(
        "open_in_run", F.max("opened").over(inside)
    )
    runs = local.groupBy("file", "run").agg(
        F.sum("size").alias("tokens"), F.sum("docs").alias("docs"), F.max("opened").alias("opened")
    )
    across = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("tokens_before", F.coalesce(F.sum("tokens").over(across), zero)).withColumn(
        "docs_before", F.coalesce(F.sum("docs").over(across), zero)
    )
    runs = runs.withColumn("opened", F.col("tokens_before") + F.col("opened")).withColumn(
        "open_before", F.coalesce(F.max("opened").over(across), zero)
    )
    bases = local.join(runs.select("file", "run", "tokens_before", "docs_before", "open_before"), ["file", "run"]).select(
        "file",
        "block",
        (F.col("tokens_before") + F.col("tokens_in_run")).alias("offset"),
        (F.col("docs_before") + F.col("docs_in_run")).alias("base"),
        F.coalesce(F.col("tokens_before") + F.col("open_in_run"), F.col("open_before")).alias("open"),
    )
    found = (
        scanned.join(bases, ["file", "block"])
        .select("file", "offset", "base", "open", F.posexplode(F.arrays_zip("ends", "lengths")).alias("i", "doc"))
        .withColumn("end", F.col("offset") + F.col("doc.ends"))
    )
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("end") - F.col("doc.lengths") + 1)
    closed = found.withColumn("start", start).select(
        "file",
        (F.col("base") + F.col("i")).alias("ordinal"),
        "start",
        (F.col("end") - F.col("start")).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    totals = runs.groupBy("file").agg(
        F.sum("tokens").alias("tokens"), F.sum("docs").alias("ordinal"), F.coalesce(F.max("opened"), zero).alias("start")
    )
    rest = totals.filter(F.col("tokens") > F.col("start")).select(
        "file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(rest)


def byte_bpe(path: str, pattern: str):
    """A tokenizer for flat_token_files: ordinary text by the ranks of a tiktoken file."""

    def load():
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return encoding.encode_ordinary

    return load


def document_token_counts(docs: DataFrame, tokenizer, end: int) -> DataFrame:
    """Writes documents as flat token files and finds each one's place and count again by its end id."""
    blocks, order = flat_token_files(docs, tokenizer, end)
    return separator_scan(blocks, end).join(order, ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens"
    )

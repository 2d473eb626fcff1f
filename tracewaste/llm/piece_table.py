"""Fill-in-the-middle examples through piece tables.

A document is never edited. It is a list of descriptors (buffer, start, length) over two immutable
buffers: its own UTF-8 bytes and the sentinels. Cutting splits descriptors, an arrangement permutes them
and puts sentinels between, and the inverse permutation of the descriptors found in an output restores
the text. Hashes and outputs are streamed from descriptors, so nothing but the bytes asked for is copied.

Cuts are counted in code points; a byte that continues none starts one, so ill-formed bytes count too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewaste.llm.tables import binary_text

SEED = 1
#: Of 100 texts, so many are transformed, and of those so many put the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Which section of a text (0 prefix, 1 middle, 2 suffix) comes where, and the sentinel before it.
ARRANGEMENTS = {PSM: ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), SPM: ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}
TEXT, MARKS = 0, 1
BLOCK = 1 << 20

Piece = tuple[int, int, int]


def piece_length(pieces: list[Piece]) -> int:
    return sum(length for _, _, length in pieces)


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and after byte ``at``; one that spans it is split."""
    head: list[Piece] = []
    for i, (buffer, start, length) in enumerate(pieces):
        if at < length:
            if at:
                return [*head, (buffer, start, at)], [(buffer, start + at, length - at), *pieces[i + 1 :]]
            return head, pieces[i:]
        head.append((buffer, start, length))
        at -= length
    return head, []


def arranged(pieces: list[Piece], first: int, second: int, form: str) -> list[Piece]:
    """The text's descriptors cut at two bytes and put in a form's order, sentinels between."""
    if form == PLAIN:
        return pieces
    prefix, rest = cut(pieces, first)
    middle, suffix = cut(rest, second - first)
    sections, marks = (prefix, middle, suffix), b"".join(SENTINELS)
    out: list[Piece] = []
    for section, mark in ARRANGEMENTS[form]:
        out.append((MARKS, marks.index(mark), len(mark)))
        out += sections[section]
    return out


def streamed(pieces: list[Piece], text: bytes) -> Iterator[memoryview]:
    """The bytes of each descriptor in turn, not copied."""
    buffers = (memoryview(text), memoryview(b"".join(SENTINELS)))
    return (buffers[buffer][start : start + length] for buffer, start, length in pieces)


def digest(pieces: list[Piece], text: bytes) -> str:
    sha = hashlib.sha256()
    for part in streamed(pieces, text):
        sha.update(part)
    return sha.hexdigest()


def restored_pieces(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output that spell the text it was made of.

    The text holds no sentinel, and none can arise where a section and a sentinel meet, since "<" is
    only first and ">" only last in one; so the first find of each is where it was put.
    """
    if form == PLAIN:
        return [(TEXT, 0, len(output))] if output else []
    starts, at = [], 0
    for _, mark in ARRANGEMENTS[form]:
        at = output.index(mark, at)
        starts.append((at, at + len(mark)))
        at += len(mark)
    ends = [start for start, _ in starts[1:]] + [len(output)]
    sections: list[Piece] = [(TEXT, 0, 0)] * 3
    for (section, _), (_, start), end in zip(ARRANGEMENTS[form], starts, ends, strict=True):
        sections[section] = (TEXT, start, end - start)
    return [piece for piece in sections if piece[2]]


def _block_starts(block: memoryview) -> np.ndarray:
    return (np.frombuffer(block, np.uint8) & 0xC0) != 0x80


def code_points(text: bytes) -> list[int]:
    """Code points of each block of ``BLOCK`` bytes."""
    view = memoryview(text)
    return [int(np.count_nonzero(_block_starts(view[i : i + BLOCK]))) for i in range(0, len(text), BLOCK)]


def byte_of(text: bytes, counts: list[int], n: int) -> int:
    """The byte at which code point ``n`` starts; the text's end if there is none. One block is searched."""
    for i, count in enumerate(counts):
        if n < count:
            block = memoryview(text)[i * BLOCK : (i + 1) * BLOCK]
            return i * BLOCK + int(np.flatnonzero(_block_starts(block))[n])
        n -= count
    return len(text)


def draws(doc_id: str, seed: int = SEED) -> list[int]:
    """The first four 32-bit numbers of the id's hash."""
    words = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(words[i : i + 8], 16) for i in range(0, 32, 8)]


def example(doc_id: str, text: bytes, seed: int = SEED):
    """(pieces, form, n, prefix, middle): a text's example as descriptors; sizes in code points."""
    counts = code_points(text)
    n = sum(counts)
    h1, h2, h3, h4 = draws(doc_id, seed)
    whole = [(TEXT, 0, len(text))] if text else []
    if not text or h3 % 100 >= TRANSFORMED or any(mark in text for mark in SENTINELS):
        return whole, PLAIN, n, None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = SPM if h4 % 100 < SUFFIX_FIRST else PSM
    pieces = arranged(whole, byte_of(text, counts, first), byte_of(text, counts, second), form)
    return pieces, form, n, first, second - first


_FACTS = [
    ("n", pa.int64()),
    ("form", pa.string()),
    ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()),
]
_FACTS_DDL = "n long, form string, prefix_chars long, middle_chars long"


def _keyed(docs: DataFrame, *carried) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(*carried, key.alias("key"), binary_text(F.col("text")).alias("text"))


def _each(batches, answer, last: list[tuple[str, pa.DataType]], carried: str):
    """``answer(key, text)`` of every row, as columns after the carried one."""
    names = [carried, *(name for name, _ in _FACTS + last)]
    for batch in batches:
        rows = [
            answer(key.as_py(), text.as_py())
            for key, text in zip(batch.column(1), batch.column(2), strict=True)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * (len(names) - 1)
        typed = [pa.array(c, t) for c, (_, t) in zip(columns, _FACTS + last, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *typed], names=names)


def fim_examples(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output): whole rows as a struct, and each one's example.

    A null text is an empty one, and an empty text, one that holds a sentinel and one in ten others are
    plain: they are their own output and have no sizes. Draws depend on the doc_id alone, a null one
    counting as empty, so repeated rows give the same output. The struct keeps clashing names apart.
    A text of any length is cut in place and copied once, into its output.
    """

    def answer(key: str, text: bytes):
        pieces, *facts = example(key, text, seed)
        n, form = facts[1], facts[0]
        return n, form, facts[2], facts[3], b"".join(streamed(pieces, text))

    def run(batches):
        return _each(batches, answer, [("output", pa.binary())], "row")

    rows = _keyed(docs, F.struct("*").alias("row"))
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, {_FACTS_DDL}, output binary").withColumn(
        "output", F.col("output").cast("string")
    )


def restored_texts(examples: DataFrame) -> DataFrame:
    """``examples`` (output, form) with the text each was made of in ``restored``; a null output stays null."""

    def run(batches):
        for batch in batches:
            outputs = (x.as_py() for x in batch.column(1))
            forms = (x.as_py() for x in batch.column(2))
            texts = [
                None if output is None else b"".join(streamed(restored_pieces(output, form or PLAIN), output))
                for output, form in zip(outputs, forms, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["row", "restored"]
            )

    rows = examples.select(F.struct("*").alias("row"), F.col("output").cast("binary"), "form")
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, restored binary").select(
        *(F.col("row")[c].alias(c) for c in examples.columns if c != "restored"),
        F.col("restored").cast("string").alias("restored"),
    )


def fim_digests(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document.

    The second hash is of the text restored from the output's bytes and form. Nulls, empty and very long
    texts, repeated rows and an empty table are as in fim_examples; further columns are left out.
    """

    def answer(key: str, text: bytes):
        pieces, form, n, prefix, middle = example(key, text, seed)
        output = b"".join(streamed(pieces, text))
        restored = digest(restored_pieces(output, form), output)
        return n, form, prefix, middle, digest(pieces, text), restored

    def run(batches):
        return _each(batches, answer, [("output_sha256", pa.string()), ("restored_sha256", pa.string())], "doc_id")

    rows = _keyed(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(run, f"doc_id long, {_FACTS_DDL}, output_sha256 string, restored_sha256 string")

"""Encoding and decoding of merge-type piece models by a table over prefixes.

In a merge-type model the encoding of a text's prefix ends in one certain token. That token is found
without merging: an automaton lists the pieces that end at a position, and the right one is the one
that may follow the last token of the prefix before it. Two tokens may be neighbours if merging the two
together would leave the border between them alone, which follows from the merges that made them. The
ids are read backwards from the table's end.

No piece of a usual model has a space mark after another character, so a text falls into words that are
encoded one by one, and frequent words are remembered up to ``REMEMBERED`` of them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewaste.llm.tables import binary_text, once_per_worker

REMEMBERED = 300_000
SPACE = "▁"
NEVER = 1 << 40
ENCODED_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def merge(text: str, rank: dict[str, int]) -> list[tuple[str, str, str]]:
    """The merges of a text in order, by trying them all: what the table must agree with."""
    parts, done = list(text), []
    while True:
        best = min(
            ((rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank),
            default=None,
        )
        if best is None:
            return done + [("", "", p) for p in parts]
        i = best[1]
        done.append((parts[i], parts[i + 1], parts[i] + parts[i + 1]))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@dataclass(frozen=True)
class Tables:
    """A model as it is sent to tasks: its file, and the last merge of each piece."""

    model: bytes
    left: np.ndarray
    right: np.ndarray


def _pieces(sp) -> dict[str, int]:
    special = (sp.is_control, sp.is_unknown, sp.is_byte, sp.is_unused)
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not any(f(i) for f in special)}


def tables_of(path: str) -> Tables:
    """Reads a merge-type model; a piece that merging never makes has no last merge (-2), a character -1."""
    with open(path, "rb") as file:
        model = file.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = _pieces(sp)
    rank = {p: -sp.get_score(i) for p, i in ids.items()}
    left, right = np.full(sp.get_piece_size(), -2, np.int32), np.full(sp.get_piece_size(), -2, np.int32)
    for piece, i in ids.items():
        if len(piece) == 1:
            left[i] = right[i] = -1
            continue
        *steps, last = merge(piece, rank)
        if steps and last[2] == piece:
            left[i], right[i] = ids[steps[-1][0]], ids[steps[-1][1]]
    return Tables(model, left, right)


class Encoder:
    """Encodes and decodes texts with one model."""

    def __init__(self, tables: Tables):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=tables.model)
        self.ids = _pieces(self.sp)
        self.left, self.right = tables.left.tolist(), tables.right.tolist()
        size = self.sp.get_piece_size()
        self.text = [""] * size
        for piece, i in self.ids.items():
            self.text[i] = piece
        order = {s: r for r, s in enumerate(sorted({self.sp.get_score(i) for i in self.ids.values()}, reverse=True))}
        self.rank = [0] * size
        for i in self.ids.values():
            self.rank[i] = -1 if self.left[i] == -1 else order[self.sp.get_score(i)]
        self.size = [len(t) for t in self.text]
        self.reached = [i for i in self.ids.values() if self.left[i] != -2]
        self.automaton = ahocorasick.Automaton()
        for i in self.reached:
            self.automaton.add_word(self.text[i], i)
        self.automaton.make_automaton()
        self.alphabet = {p for p in self.ids if len(p) == 1}
        self.bytes_of = {b: self.sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        marks = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        breaks = not any("\n" in p for p in self.ids)
        inside = f"[^{SPACE}\n]" if breaks else f"[^{SPACE}]"
        self.words = re.compile(f"{SPACE}*{inside}+|{SPACE}+|\n" if marks else "(?s:.+)").findall
        self.may_follow: dict[int, bool] = {}
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether token b may follow token a: no merge across their border comes before those that made them.

        The merges along the border are undone from the last one back. Of two merges to the same piece,
        the left one comes first.
        """
        rank, ids, text = self.rank, self.ids, self.text
        used_a = used_b = NEVER
        while True:
            across = ids.get(text[a] + text[b])
            if across is not None and rank[across] < used_a and rank[across] <= used_b:
                return False
            if rank[a] > rank[b]:
                used_a, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                used_b, b = rank[b], self.left[b]
            else:
                return True

    def _known_characters(self, word: str) -> list[int]:
        last = [-1] * (len(word) + 1)
        size, may_follow = self.size, self.may_follow
        for end, token in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size[token]
            if start:
                before = last[start]
                pair = before << 20 | token
                fits = may_follow.get(pair)
                if fits is None:
                    fits = may_follow[pair] = self.compatible(before, token)
                if not fits:
                    continue
            last[end] = token
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= size[last[at]]
        return out[::-1]

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        if self.alphabet.issuperset(word):
            ids = self._known_characters(word)
        else:
            ids, run = [], ""
            for c in word:
                if c in self.alphabet:
                    run += c
                    continue
                ids += [*self._known_characters(run), *(self.bytes_of[b] for b in c.encode())]
                run = ""
            ids += self._known_characters(run)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(self.may_follow) >= REMEMBERED * 4:
            self.may_follow.clear()
        found = self.known[word] = (tuple(ids), " ".join(map(str, ids)))
        return found

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids without an end id, and the same as text."""
        if not text:
            return [], ""
        known = self.known
        found = [
            known.get(w) or self._word(w) for w in self.words(SPACE + text.replace(" ", SPACE))
        ]
        return list(chain.from_iterable(f[0] for f in found)), " ".join([f[1] for f in found])

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


def _digests(tables: Tables, end: int):
    def run(batches):
        encoder = once_per_worker(f"pieces {zlib.crc32(tables.model)}", lambda: Encoder(tables))
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids, said = encoder.encode(text.decode("utf-8", "replace"))
                ids.append(end)
                said = f"{said} {end}" if said else str(end)
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(said.encode()).hexdigest(),
                        hashlib.sha256(encoder.decode(ids).encode()).hexdigest(),
                    )
                )
            n, ids_digest, text_digest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_digest, pa.string()),
                 pa.array(text_digest, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _ids(tables: Tables, end: int | None):
    def run(batches):
        encoder = once_per_worker(f"pieces {zlib.crc32(tables.model)}", lambda: Encoder(tables))
        for batch in batches:
            ids = [encoder.encode(t.decode("utf-8", "replace"))[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x + [end] * (end is not None) for x in ids], pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )

    return run


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text(F.col("text")).alias("text"))


def encode_documents(docs: DataFrame, model_path: str, end: int | None = 2) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, with an end id unless ``end`` is None.

    A null text is an empty one, which has no id but the end id. A character that the model lacks is
    written as its bytes. Repeated rows are encoded each; further columns are left out.
    """
    return _slim(docs).mapInArrow(_ids(tables_of(model_path), end), "doc_id long, ids array<int>")


def encoded_digests(docs: DataFrame, model_path: str, end: int = 2) -> DataFrame:
    """Number of ids of each whole text, and digests of the ids and of their decoding; see encode_documents."""
    return _slim(docs).mapInArrow(_digests(tables_of(model_path), end), ENCODED_DDL)

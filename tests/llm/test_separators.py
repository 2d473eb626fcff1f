import numpy as np
import public_tokenizers
import pytest
from conftest import texts

from tracewaste.llm import separators as s
from tracewaste.llm.queries import BYTE_END, BYTE_RANKS

END = 9


def brute_force(ids):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == END:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize(("block", "run"), [(1, 2), (3, 2), (7, 3), (1000, 1024)])
def test_scan_against_a_loop(spark, monkeypatch, block, run):
    monkeypatch.setattr(s, "RUN_BLOCKS", run)
    rng = np.random.default_rng(block)
    files = {
        "none": np.full(50, 1),
        "only": np.full(20, END),
        "open": np.array([1, END, 2, 2]),
        "long": np.concatenate([np.full(200, 3), [END], np.full(90, 4), [END, END]]),
        "mixed": rng.integers(0, 10, 300),
        "empty": np.zeros(0, int),
    }
    rows = []
    for name, ids in files.items():
        parts = [ids[i : i + block] for i in range(0, max(1, len(ids)), block)]
        rows += [(name, i, p.astype("<u2").tobytes(), 1) for i, p in enumerate(parts)]
    rows += [("x", 0, None, 1), (None, 0, b"\x09\x00", 1)]
    table = spark.createDataFrame(rows, "file string, block long, ids binary, size int")
    got = s.separator_scan(table, END).collect()
    wanted = [(name, *r) for name, ids in files.items() for r in brute_force(ids.tolist())]
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_documents(make, monkeypatch):
    monkeypatch.setattr(s, "RUN_BLOCKS", 2)
    docs, rows = make(texts(80))
    tokenizer = s.byte_bpe(BYTE_RANKS, public_tokenizers.PATTERN)
    encode = tokenizer()
    blocks, order = s.flat_token_files(docs, tokenizer, BYTE_END, block_tokens=64)
    assert max(len(r["ids"]) for r in blocks.collect()) == 128
    found = s.separator_scan(blocks, BYTE_END).join(order, ["file", "ordinal"]).collect()
    wanted = sorted((-1 if r[0] is None else r[0], len(encode(r[1] or ""))) for r in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in found) == wanted
    assert all(r["closed"] for r in found)
    whole = s.document_token_counts(docs, tokenizer, BYTE_END).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in whole) == wanted


def test_files_on_disk(spark, tmp_path):
    ids = np.array([1, 2, END, 3, END, 4, 4], "<u4")
    (tmp_path / "a.bin").write_bytes(ids.tobytes() + b"\x01")
    (tmp_path / "b.bin").write_bytes(b"")
    blocks = s.read_token_files(spark, str(tmp_path), "<u4", 2)
    got = s.separator_scan(blocks, END, "<u4").drop("file").collect()
    assert sorted(map(tuple, got)) == brute_force(ids.tolist())


def test_empty_tables(spark, empty):
    assert s.separator_scan(spark.createDataFrame([], "file string, block long, ids binary"), END).collect() == []
    assert s.document_token_counts(empty, s.byte_bpe(BYTE_RANKS, public_tokenizers.PATTERN), BYTE_END).collect() == []

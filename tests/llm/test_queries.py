"""Whole rows of the queries without SQL, against brute force on sf0.01."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tessera.llm.packing import bin_bound
from tessera.llm.queries import QUERIES

from .conftest import SF01


def _rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF01).collect()]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def _sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def byte_ids(docs01):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in docs01.items()}


def test_byte_bpe(spark, docs01):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, text in docs01.items():
        ids = encoder.encode_ordinary(text)
        want[i] = {"doc_id": i, "n_tokens": len(ids), "ids_sha256": _sha(" ".join(map(str, ids)).encode()), "decoded_sha256": _sha(text.encode())}
    got = _rows(spark, "op4_byte_bpe")
    assert len(got) == len(want) and {r["doc_id"]: r for r in got} == want


def test_token_files(spark, docs01):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = {}, 0
    for i in sorted(docs01):
        ids = [*library.encode(docs01[i], add_special_tokens=False).ids, 2]
        want[i] = {"doc_id": i, "start": start, "n_tokens": len(ids), "ids_crc32": _crc(ids)}
        start += len(ids)
    got = _rows(spark, "op7_token_files")
    assert len(got) == len(want) and {r["doc_id"]: r for r in got} == want


def _check_places(rows, limit):
    """Sequences hold their pieces without gaps; how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= limit
    return by


def test_best_fit_packing(spark, byte_ids):
    rows = _rows(spark, "op9_best_fit_packing")
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(byte_ids)
    for i, pieces in by_doc.items():
        ids, start = [*byte_ids[i], 2], 0
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 1024)
        assert all(p["length"] == 1024 for p in pieces[1:])
        for p in pieces:
            assert p["start"] == start and p["ids_crc32"] == _crc(ids[start:start + p["length"]])
            start += p["length"]
        assert start == len(ids)
    bound = bin_bound(np.array([r["length"] for r in rows]), 1024)
    assert bound <= len(_check_places(rows, 1024)) <= bound + 3


def test_window_fill(spark, byte_ids):
    rows = _rows(spark, "op12_window_fill")
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(byte_ids)
    for i, pieces in by_doc.items():
        ids, start = [*byte_ids[i], 1], 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == start and p["doc_tokens"] == len(ids) and p["ids_crc32"] == _crc(ids[start:start + p["length"]])
            start += p["length"]
        assert start == len(ids)
    _check_places(rows, 2048)


def test_sharding(spark, docs01):
    rows = _rows(spark, "op10_sharding")
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", None) for i, t in docs01.items()}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(8)) and len(rows) == len(docs01)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1

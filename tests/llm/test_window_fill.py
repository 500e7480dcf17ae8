"""Windows filled by least squares: whole documents, exact windows, no padding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import _hub, window_fill
from tessera.llm.queries import QUERIES

from .conftest import SF01

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, AS_TEXT = Tokenizer.from_file(PATH), Tokenizer.from_file(PATH)
AS_TEXT.encode_special_tokens = True
LIBRARY_OF = {False: LIBRARY, True: AS_TEXT}


def check(rows, ids, capacity, ends=1):
    """``rows`` hold each document of ``ids`` (a list per key) once, in gapless sequences without padding."""
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by) == set(ids)
    for key, mine in by.items():
        at = 0
        for r in sorted(mine, key=lambda r: r["start"]):
            part = np.array(ids[key][at:at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"]) == (at, len(ids[key])) and 0 < r["length"] <= capacity
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and ("ids" not in r or r["ids"] == part.tolist())
            at += r["length"]
        assert at == len(ids[key])
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    short = [s for s in sizes if s != capacity]
    assert len(short) == len(set(short)) and all(s & (s - 1) == 0 and s < capacity for s in short)
    return sizes


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=80), st.sampled_from([1, 2, 5, 32, 64]), st.sampled_from([1, 3, 16]), st.booleans())
def test_windows_of_any_sizes(sizes, capacity, stride, last):
    item, start, length, sequence, offset = window_fill.fill_windows(np.array(sizes, np.int64), capacity, last, stride)
    for k, n in enumerate(sizes):
        mine = sorted((start[item == k][j], length[item == k][j]) for j in range((item == k).sum()))
        assert [a for a, _ in mine] == np.cumsum([0] + [b for _, b in mine])[:-1].tolist() and sum(b for _, b in mine) == n
    left = int(length[sequence < 0].sum())
    assert left == (0 if last else sum(sizes) % capacity)
    for s in set(sequence[sequence >= 0].tolist()):
        rows = sorted(zip(offset[sequence == s].tolist(), length[sequence == s].tolist(), strict=True))
        assert [o for o, _ in rows] == np.cumsum([0] + [n for _, n in rows])[:-1].tolist()
        total = sum(n for _, n in rows)
        assert total == capacity or last and total & (total - 1) == 0


def test_combinations_fill_the_window():
    sets = window_fill.combinations(64, 1)
    brute = {(a, b, 64 - a - b) for a in range(1, 65) for b in range(0, a + 1) if b >= 64 - a - b >= 0 and 0 < b} - {(64, 0, 0)}
    assert set(map(tuple, sets.tolist())) == brute and len(sets) == len(brute)
    thin = window_fill.combinations(2048, 16)
    assert (thin.sum(1) == 2048).all() and len(thin) < 25_000 and len(np.unique(thin)) == 2048


def test_least_squares_meets_a_histogram():
    """A histogram made of combinations is met; the counts used never exceed it and leave little."""
    rng = np.random.default_rng(1)
    sets = window_fill.combinations(256, 4)
    picked = rng.integers(0, len(sets), 40)
    counts = np.zeros(257, np.int64)
    for k in picked:
        for n in sets[k]:
            counts[n] += 500 * (n > 0)
    x = window_fill.least_squares(sets, counts.astype(float), 400)
    met = np.bincount(sets.ravel(), np.repeat(x, 3), 257)[1:]
    assert (x >= 0).all() and np.abs(met - counts[1:]).sum() < 0.03 * counts.sum()
    used, times = window_fill.repeat_counts(counts, 4)
    taken = np.bincount(used.ravel(), np.repeat(times, 3), 257)[1:]
    assert (taken <= counts[1:]).all() and taken.sum() > 0.97 * counts.sum()


def test_few_documents_are_cut():
    """Concatenation cuts a document at nearly every window's end; least squares at far fewer, the fewer the more documents."""
    for n, share in ((20_000, 0.15), (200_000, 0.06)):
        sizes = np.random.default_rng(2).integers(1, 2048, n)
        item, *_ = window_fill.fill_windows(sizes, 2048, True)
        assert len(item) - n < share * sizes.sum() / 2048


def test_pack_edges(spark, edges, nothing):
    frame = edges.withColumn("key", F.monotonically_increasing_id()).withColumn("length", F.lit("mine")).cache()
    ids = {r["key"]: LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in frame.collect()}
    rows = window_fill.pack_windows(frame, PATH, 1, 64, carry=["key", "length", "n.lines"], special_as_text=False, block_tokens=500)
    assert rows.columns == ["key", "n.lines", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    check([r.asDict() for r in rows.withColumnRenamed("key", "doc_id").drop("n.lines").collect()], ids, 64)
    assert window_fill.pack_windows(nothing, PATH, 1, 64).collect() == []


def test_ends_meet_in_several_cells(spark):
    """More ends than one cell holds: rounds go on until one cell is left."""
    frame = spark.range(0, 600, 1, 40).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', cast(id % 13 as int))").alias("text"))
    ids = {r["doc_id"]: LIBRARY.encode(r["text"], add_special_tokens=False).ids + [1] for r in frame.collect()}
    rows = window_fill.pack_windows(frame, PATH, 1, 128, special_as_text=False, with_ids=False, block_tokens=200)
    check([r.asDict() for r in rows.collect()], ids, 128)


def test_query_equals_the_library(spark, docs01):
    ids = {i: LIBRARY.encode(t, add_special_tokens=False).ids + [1] for i, t in docs01.items()}
    sizes = check([r.asDict() for r in QUERIES["op12_window_fill"](spark, SF01).collect()], ids, 2048)
    assert len(sizes) <= sum(map(len, ids.values())) // 2048 + 11


ODD = st.text(st.one_of(st.sampled_from("  \n\t\r  \x1c.,'!<|>_ab1sé́ßΣς😀İ"), st.characters(codec="utf-8")), max_size=60)


@pytest.mark.parametrize("special_as_text", [True, False])
@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.one_of(ODD, st.lists(st.one_of(ODD, st.just("<|endoftext|>"))).map("".join)), max_size=6))
def test_byte_level_ids_are_the_librarys(texts, special_as_text):
    library = LIBRARY_OF[special_as_text]
    model = _hub.byte_level(PATH, special_as_text)
    assert isinstance(model, _hub.ByteLevelTokenizer)
    ids, offsets = model.encode(texts, 2)
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids + [2]


def test_byte_level_cuts_alike_at_every_code_point():
    model, points = _hub.byte_level(PATH), [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)}.{chr(c)} {chr(c)}{chr(c)}\n" for c in points[at:at + 512]) for at in range(0, len(points), 512)]
    ids, offsets = model.encode(texts)
    for k, found in enumerate(LIBRARY.encode_batch_fast(texts, add_special_tokens=False)):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == found.ids


def test_other_files_go_through_the_library():
    assert isinstance(_hub.byte_level(public_tokenizers.path("word_bpe_49k.json")), _hub.FileTokenizer)

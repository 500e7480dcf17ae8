"""Byte-level BPE on public ranks, by a segment tree.

Each pre-token's bytes are the leaves of a segment tree that keeps the least
(rank, position) of all adjacent pairs, so its root is the leftmost pair of
lowest rank.  A merge changes three leaves: the pair itself, its left
neighbour's pair, and the right part, which goes; each is a walk to the root.
Distinct short pre-tokens have their trees side by side in numpy arrays.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, map_arrow, ragged, ship, without
from tessera.llm._words import WordCache, chunks

_NONE = 1 << 62
_ready: dict[tuple[str, str], "ByteBPE"] = {}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n == 0:
        return []
    size = 1 << max(1, (n - 1).bit_length())
    tree = [_NONE] * (2 * size)
    end = list(range(1, n + 1))  # of the part that begins here; its neighbour's start
    left = list(range(-1, n - 1))

    def pair(i: int) -> int:
        j = end[i]
        if j >= n:
            return _NONE
        rank = ranks.get(piece[i:end[j]])
        return _NONE if rank is None else rank << 32 | i

    for i in range(n - 1):
        tree[size + i] = pair(i)
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b

    def update(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            best = a if a < b else b
            if tree[k] == best:
                break
            tree[k] = best

    while tree[1] != _NONE:
        i = tree[1] & 0xFFFFFFFF
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            left[end[i]] = i
        update(j, _NONE)
        update(i, pair(i))
        if left[i] >= 0:
            update(left[i], pair(left[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class MergeTable:
    """Rank of every pair of tokens whose bytes together are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.full(256, -1, np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[order], _NONE)
        self.values = np.append(np.array(values, np.int64)[order], _NONE)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], _NONE)


#: Longest pre-token that is merged together with others of its size class.
_TOGETHER = 64


def merge_together(pieces: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and id counts of pre-tokens of 2 to ``_TOGETHER`` bytes of one
    size class: the segment trees of all of them side by side, one merge in
    each at a time."""
    count = np.array([len(p) for p in pieces], np.int64)
    rows, size = len(pieces), 1 << int(count.max() - 1).bit_length()
    at = np.arange(size + 1)
    data = np.frombuffer(b"".join(p.ljust(size + 1, b"\0") for p in pieces), np.uint8).reshape(rows, size + 1)
    token, alive = table.single[data], at[None, :] < count[:, None]
    after = np.broadcast_to(at + 1, (rows, size + 1)).copy()
    before = np.broadcast_to(at - 1, (rows, size + 1)).copy()

    def leaf(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        """(rank, place) of the pair that begins at place i of rows r."""
        j = after[r, i]
        rank = table.rank(token[r, i], token[r, np.minimum(j, size)])
        return np.where((j < count[r]) & (rank != _NONE), rank << 8 | i, _NONE)

    tree = np.full((rows, 2 * size), _NONE, np.int64)
    everyone = np.arange(rows)
    for i in range(size):
        tree[:, size + i] = np.where(i + 1 < count, leaf(everyone, np.full(rows, i)), _NONE)
    level = size
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    r = np.flatnonzero(tree[:, 1] != _NONE)
    while len(r):
        best = tree[r, 1]
        i = best & 0xFF
        j = after[r, i]
        end = after[r, j]
        token[r, i], after[r, i], before[r, end], alive[r, j] = best >> 8, end, i, False
        p = before[r, i]
        paths = [(r, j, np.full(len(r), _NONE)), (r, i, leaf(r, i))]
        has = p >= 0
        paths.append((r[has], p[has], leaf(r[has], p[has])))
        for q, place, value in paths:  # all leaves first, then each path to its root
            tree[q, size + place] = value
        for q, place, _ in paths:
            k = size + place >> 1
            for _ in range(size.bit_length() - 1):
                tree[q, k] = np.minimum(tree[q, 2 * k], tree[q, 2 * k + 1])
                k = k >> 1
        r = r[tree[r, 1] != _NONE]
    return token[alive], alive.sum(axis=1)


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], table: MergeTable, side_by_side: int = 4096) -> list[np.ndarray]:
    """Token ids of each pre-token."""
    out: list[np.ndarray | None] = [None] * len(pieces)
    classes: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        whole = ranks.get(piece)
        if whole is not None:
            out[k] = np.array([whole], np.int64)
        elif len(piece) < 2 or len(piece) > _TOGETHER:
            out[k] = np.array(merge_bytes(piece, ranks), np.int64)
        else:
            classes.setdefault((len(piece) - 1).bit_length(), []).append(k)
    for members in classes.values():
        for a in range(0, len(members), side_by_side):
            some = members[a:a + side_by_side]
            flat, sizes = merge_together([pieces[k] for k in some], table)
            for k, ids in zip(some, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
                out[k] = ids
    return out


class ByteBPE:
    """Encoder and decoder over one file of ranks; one per worker process."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern, self.table = regex.compile(pattern), MergeTable(self.ranks)
        self.cache = WordCache(self._encode_chunks)
        vocab = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            vocab[rank] = token
        self.sizes = np.array([len(v) for v in vocab], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(vocab), np.uint8)

    def _encode_chunks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.pattern.findall(w) for w in words]
        place = {m: k for k, m in enumerate(dict.fromkeys(m for p in parts for m in p))}
        ids = merge_all([m.encode("utf-8") for m in place], self.ranks, self.table)
        sizes = [sum(len(ids[place[m]]) for m in p) for p in parts]
        flat = [ids[place[m]] for p in parts for m in p]
        return np.concatenate(flat) if flat else np.zeros(0, np.int64), np.array(sizes, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and row offsets."""
        return self.cache.encode([chunks(t) for t in texts])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat bytes and row offsets."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends[:-1], sizes)
        return self.bytes[at], ends[offsets]


def _loaded(path: str, pattern: str) -> ByteBPE:
    if (path, pattern) not in _ready:
        _ready[path, pattern] = ByteBPE(path, pattern)
    return _ready[path, pattern]


def encode_text(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
                slice_rows: int = 256) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), the byte-level BPE ids of the whole text.

    Each match of ``pattern`` is encoded by itself; strings of special tokens
    are ordinary text.  Null and empty texts have no ids; repeated rows are
    encoded each; an empty table gives an empty result; an input column named
    like ``ids_col`` gives way to it.  No shuffle: a task holds ``slice_rows`` rows
    and a bounded cache of encoded words.
    """
    ship(docs.sparkSession)
    keep = without(docs, [ids_col])
    text = hidden_text(keep)
    frame = docs.select(*[col(c) for c in keep], col(text_col).alias(text))
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep] + [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                ids, offsets = model.encode(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ragged(ids, offsets, pa.int32())],
                                                 names=[*keep, ids_col])

    return map_arrow(frame, encode, schema)


def decode_ids(frame: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded",
               slice_rows: int = 256) -> DataFrame:
    """``frame`` with the bytes its ids stand for (binary); null ids give no
    bytes.  Ids outside the vocabulary fail the job."""
    ship(frame.sparkSession)
    keep = without(frame, [bytes_col])
    ids_name = hidden_text(keep)
    source = frame.select(*[col(c) for c in keep], F.coalesce(col(ids_col), F.array().cast("array<int>")).alias(ids_name))
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + [T.StructField(bytes_col, T.BinaryType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                lists = part.column(part.num_columns - 1)
                offsets = lists.offsets.to_numpy().astype(np.int64)
                flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
                data, ends = model.decode(flat, offsets - offsets[0])
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [
                    None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out.cast(pa.binary())], names=[*keep, bytes_col])

    return map_arrow(source, decode, schema)


def hidden_text(names: list[str]) -> str:
    name, low = "__text", {n.lower() for n in names}
    while name in low:
        name += "_"
    return name

"""Packing documents into full windows by non-negative least squares.

Texts are tokenised once, in the task that reads them, and packed there in
blocks of a bounded number of tokens.  A document longer than a window gives
full windows and a remainder.  The remainders of a block are a histogram of
lengths.  Combinations of two or three lengths that fill a window exactly are
enumerated; non-negative least squares says how often each should be used so
that the histogram is met; the counts are rounded and held to what is there.  What they
leave is packed greedily, longest first, the document at the end of a window
being cut there.  Less than one window of each block is left over; these ends meet in
cells and are packed in the same way until one cell is left, whose end is cut
at powers of two.  So no sequence holds padding, and no text moves between tasks but the ends.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, map_arrow, ragged, ship, stored, text_slices, without
from tessera.llm._hub import byte_level

_LOCAL = 33  # bits of a sequence's number within its task or cell; the task's number and the round stand above


@cache
def combinations(capacity: int, stride: int) -> np.ndarray:
    """Rows of two or three lengths (0 for none) that add up to ``capacity``; of the
    threes, those whose larger two differ by a multiple of ``stride``."""
    half = np.arange(-(-capacity // 2), capacity)
    pairs = np.stack([half, capacity - half, np.zeros_like(half)], 1)
    threes = []
    for a in range(-(-capacity // 3), capacity - 1):
        b = np.arange(a, max(0, (capacity - a - 1) // 2), -stride)
        c = capacity - a - b
        fits = (c >= 1) & (c <= b)
        threes.append(np.stack([np.full(int(fits.sum()), a), b[fits], c[fits]], 1))
    return np.concatenate([pairs, *threes]).astype(np.int64)


def least_squares(sets: np.ndarray, counts: np.ndarray, turns: int = 100) -> np.ndarray:
    """``x >= 0`` that brings ``sum of x over the sets that hold a length`` close to the
    length's count, by accelerated projected gradients.  A count is met
    within a share of itself (rows are scaled by its root), so rare lengths
    are not lost among common ones."""
    size = len(counts)
    weight = np.where(counts > 0, 1 / np.sqrt(np.maximum(counts, 1)), 1.0)
    weight[0] = 0
    flat = sets.ravel()

    def times(x: np.ndarray) -> np.ndarray:
        return weight * np.bincount(flat, np.repeat(x, 3), size)

    def back(r: np.ndarray) -> np.ndarray:
        return (weight * r)[sets].sum(1)

    target = weight * counts
    bound = back(times(np.ones(len(sets))))  # row sums of a non-negative matrix bound it: a step for each set
    x = y = np.zeros(len(sets))
    t = 1.0
    for _ in range(turns):
        new = np.maximum(y - back(times(y) - target) / bound, 0)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = new + (old - 1) / t * (new - x), new
    return x


def repeat_counts(counts: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sets, times)``: how often each combination is used, never beyond the counts."""
    capacity = len(counts) - 1
    sets = combinations(capacity, stride)
    there = np.append(True, counts[1:] > 0)
    sets = sets[there[sets].all(1)]  # a combination with an absent length has no use
    if len(sets) == 0:
        return sets, np.zeros(0, np.int64)
    x = least_squares(sets, counts.astype(float))
    wanted = np.diff(np.floor(np.append(0, np.cumsum(x)) + 0.5)).astype(np.int64)  # rounded sums keep the total
    left, times = counts.tolist(), np.zeros(len(sets), np.int64)

    def use(k: int, most: int | None) -> None:
        a, b, c = sets[k].tolist()
        need: dict[int, int] = {}
        for n in (a, b, c):
            if n:
                need[n] = need.get(n, 0) + 1
        fit = min(left[n] // m for n, m in need.items())
        fit = fit if most is None else min(fit, most)
        for n, m in need.items():
            left[n] -= fit * m
        times[k] += fit

    for k in np.argsort(-wanted, kind="stable")[:np.count_nonzero(wanted)].tolist():
        use(k, int(wanted[k]))
    remaining = np.array(left)
    remaining[0] = 1
    for k in np.flatnonzero((remaining[sets] > 0).all(1)).tolist():  # what rounding left over
        use(k, None)
    return sets, times


def fill_windows(sizes: np.ndarray, capacity: int, last: bool, stride: int = 16) -> tuple[np.ndarray, ...]:
    """Pieces of items of these sizes: ``(item, start, length, sequence, offset)``; each
    sequence has ``capacity`` places and no gap.  What is left, less than a
    window, has sequence -1 or, if ``last``, is cut into sequences of powers of two."""
    items = np.arange(len(sizes))
    full, rest = sizes // capacity, sizes % capacity
    item = np.repeat(items, full)
    start = (np.arange(len(item)) - np.repeat(np.cumsum(full) - full, full)) * capacity
    parts = [(item, start, np.full(len(item), capacity), np.arange(len(item)), np.zeros(len(item), np.int64))]
    n_sequences = len(item)

    counts = np.bincount(rest, minlength=capacity + 1)
    counts[0] = 0
    sets, times = repeat_counts(counts, stride)
    used = np.flatnonzero(times)
    members, offsets = sets[used], np.cumsum(sets[used], 1) - sets[used]
    sequence = np.arange(int(times.sum())) + n_sequences
    lengths, offsets = (np.repeat(v, times[used], 0).ravel() for v in (members, offsets))
    sequence = np.repeat(sequence, 3)[lengths > 0]
    lengths, offsets = lengths[lengths > 0], offsets[lengths > 0]
    n_sequences += int(times.sum())

    by_length = items[rest > 0][np.argsort(rest[rest > 0], kind="stable")]
    of_length = rest[by_length]
    order = np.argsort(lengths, kind="stable")
    lengths, offsets, sequence = lengths[order], offsets[order], sequence[order]
    rank = np.arange(len(lengths)) - np.searchsorted(lengths, lengths)
    place = np.searchsorted(of_length, lengths) + rank
    item = by_length[place]
    parts.append((item, full[item] * capacity, lengths, sequence, offsets))

    open_ = np.ones(len(by_length), bool)
    open_[place] = False
    item, length = by_length[open_][::-1], of_length[open_][::-1]  # longest first, one after another
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    edges = list(range(0, total + 1, capacity))
    if last:
        for bit in range((total - edges[-1]).bit_length() - 1, -1, -1):
            if total - edges[-1] >= 1 << bit:
                edges.append(edges[-1] + (1 << bit))
    edges_, begins = np.array(edges), ends - length
    at = np.unique(np.concatenate([begins, edges_[edges_ < total]]))
    size = np.diff(np.append(at, total))
    k, s = np.searchsorted(begins, at, "right") - 1, np.searchsorted(edges_, at, "right") - 1
    placed = s < len(edges_) - 1
    parts.append((item[k], full[item[k]] * capacity + at - begins[k], size, np.where(placed, n_sequences + s, -1), np.where(placed, at - edges_[s], 0)))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True))


def pack_windows(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, carry: Sequence[str] = ("doc_id",), text_col: str = "text",
                 special_as_text: bool = True, with_ids: bool = True, block_tokens: int = 1 << 22, stride: int = 16) -> DataFrame:
    """``carry`` columns with ``start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, ``with_ids``, ``ids``: one row
    per piece.  A document is the tokens of its whole text (a byte-level vocabulary) and ``end_id``; ``start`` counts
    its ids before the piece, ``doc_tokens`` all its ids.  Sequences have exactly ``capacity`` ids, but for at most
    one per power of two.

    Null and empty texts are ``end_id`` alone; rows that repeat an id or a text are packed each; an empty
    table gives an empty result; input columns named like the new ones give way.  Texts of any length are taken whole: a
    task holds ``block_tokens`` ids, or one document's if it has more.  Strings of special tokens in a
    text are those tokens unless ``special_as_text``.
    """
    spark = docs.sparkSession
    ship(spark)
    own = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    carry = [c for c in carry if c in without(docs, own)]
    plain = [f"c{k}" for k in range(len(carry))]
    frame = docs.select(*[col(c).alias(p) for c, p in zip(carry, plain, strict=True)], col(text_col).alias("text"))
    long, ids_kind = T.LongType(), T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(p, docs.schema[c].dataType) for c, p in zip(carry, plain, strict=True)]
                          + [T.StructField(c, long) for c in own[:-1]] + [T.StructField("ids", ids_kind)])

    def pieces(rows: pa.RecordBatch, begin: np.ndarray, doc_tokens: np.ndarray, ids: np.ndarray, sizes: np.ndarray, last: bool,
               first_id: int) -> tuple[pa.RecordBatch, int]:
        """The pieces of items of ``sizes`` ids each, laid out one after another in ``ids``."""
        item, start, length, sequence, offset = fill_windows(sizes, capacity, last, stride)
        from_ = (np.cumsum(sizes) - sizes)[item] + start
        view = memoryview(ids.astype("<u4", copy=False))
        crc = [zlib.crc32(view[a:b]) for a, b in zip(from_.tolist(), (from_ + length).tolist(), strict=True)]
        shown = np.ones(len(item), bool) if with_ids else sequence < 0  # ends go on with their ids
        held = np.where(shown, length, 0)
        at = np.repeat(from_ - (np.cumsum(held) - held), held) + np.arange(int(held.sum()))
        lists = ragged(ids[at].astype(np.int32), np.append(0, np.cumsum(held)), pa.int32())
        if not shown.all():
            lists = pc.if_else(pa.array(shown), lists, pa.scalar(None, lists.type))
        n = int(sequence.max(initial=-1)) + 1
        numbered = np.where(sequence < 0, -1, first_id + sequence)
        picked = pa.array(item)
        columns = [c.take(picked) for c in rows.columns[:len(plain)]]
        columns += [pa.array(x) for x in (begin[item] + start, length, np.array(crc, np.int64), doc_tokens[item], numbered, offset)]
        return pa.RecordBatch.from_arrays([*columns, lists], names=schema.names), n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_level(tokenizer_path, special_as_text)
        next_id = TaskContext.get().partitionId() << _LOCAL
        held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        n_held = 0

        def close() -> pa.RecordBatch:
            nonlocal held, n_held, next_id
            rows = pa.Table.from_batches([h[0] for h in held]).combine_chunks().to_batches()[0]
            ids, sizes = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            held, n_held = [], 0
            out, n = pieces(rows, np.zeros(len(sizes), np.int64), sizes, ids, sizes, False, next_id)
            next_id += n
            return out

        for batch in batches:
            for a, b, _, _ in text_slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(a, b - a)
                ids, offsets = model.encode(part.column(part.num_columns - 1).to_pylist(), end_id)
                held.append((pa.RecordBatch.from_arrays(part.columns[:-1], names=plain), ids.astype(np.uint32), np.diff(offsets)))
                n_held += len(ids)
                if n_held >= block_tokens:
                    yield close()
        if held:
            yield close()

    done = stored(map_arrow(frame, read, schema), "window-pieces")
    parts, turn = [done.where("sequence_id >= 0")], 0
    ends = done.where("sequence_id < 0")
    n_left = ends.agg(F.sum("length")).first()[0] or 0
    while n_left:
        turn += 1
        cells = -(-n_left // block_tokens)
        last = cells == 1

        def meet(table: pa.Table) -> pa.Table:
            cell = int(table.column("cell")[0].as_py())
            rows = table.drop_columns(["cell", "key"]).take(pc.sort_indices(table, [("key", "ascending")]))
            rows = rows.combine_chunks().to_batches()[0]
            lists = rows.column("ids")
            ids = lists.flatten().to_numpy().astype(np.uint32)
            begin, tokens = (rows.column(c).to_numpy() for c in ("start", "doc_tokens"))
            out, _ = pieces(rows, begin, tokens, ids, rows.column("length").to_numpy(), last, (turn << 56) + (cell << _LOCAL))
            return pa.Table.from_batches([out])

        keyed = ends.withColumn("key", F.monotonically_increasing_id())
        keyed = keyed.withColumn("cell", F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(cells)).cast("bigint"))
        done = stored(keyed.groupBy("cell").applyInArrow(meet, schema), "window-ends")
        parts.append(done.where("sequence_id >= 0"))
        ends = done.where("sequence_id < 0")
        n_left = 0 if last else ends.agg(F.sum("length")).first()[0] or 0
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.toDF(*carry, *own)
    return out if with_ids else out.drop("ids")

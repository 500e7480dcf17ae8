"""Packing token pieces into sequences, with certificates.

Every partition packs its pieces by best fit decreasing and compares its
number of bins with a lower bound from dual-feasible functions.  Partitions
that meet the bound are certified and done.  The others (with the partitions'
half-empty last bins) release the pieces of their bins with free room; these
are dealt anew to fewer partitions and packed again, until nothing is gained.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, map_arrow, ragged, ship, stored, without
from tessera.llm._hub import byte_level


def bin_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of
    dual-feasible functions (large and small items cut at a threshold; item
    sizes rounded to k-ths)."""
    if len(lengths) == 0:
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    n_up, sum_up = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * size)])
    cut = np.arange(capacity // 2 + 1)
    large = n_up[-1] - n_up[capacity - cut + 1]
    middle = sum_up[capacity - cut + 1] - sum_up[cut]
    best = int((large + -(-middle // capacity)).max())
    for k in range(1, 33):
        part = np.where((k + 1) * size % capacity == 0, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * part).sum()) // (capacity * k)))
    return max(best, 1)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the free room of each bin; items are
    taken longest first, each into the fullest bin that has room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set while a bin with r free places exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            b, room = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        free[b] = room - n
        by_room[room - n].append(b)
        open_rooms |= 1 << (room - n)
    return bins, offsets, np.array(free, np.int64)


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, carry: Sequence[str] = ("doc_id",),
               text_col: str = "text", slice_rows: int = 256, special_as_text: bool = True) -> DataFrame:
    """``carry`` columns with ``piece, start, length, ids``: the tokens of each
    text and ``end_id``, cut only if longer than ``capacity``, into full pieces
    but for the first.  Null and empty texts give one piece of ``end_id``.
    Strings of special tokens in a text are those tokens unless ``special_as_text``."""
    ship(docs.sparkSession)
    carry = list(carry)
    frame = docs.select(*[col(c) for c in carry], col(text_col).alias("__text"))
    kinds = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
             T.StructField("length", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    schema = T.StructType([docs.schema[c] for c in carry] + kinds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_level(tokenizer_path, special_as_text)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                ids, offsets = model.encode(part.column(part.num_columns - 1).to_pylist(), end_id)
                size = np.diff(offsets)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = size - (pieces - 1) * capacity
                start = np.where(number == 0, 0, first[row] + (number - 1) * capacity)
                length = np.where(number == 0, first[row], capacity)
                ends = np.concatenate([[0], np.cumsum(length)])  # the pieces follow each other in ids
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(row)) for c in part.columns[:-1]), pa.array(number.astype(np.int32)),
                     pa.array(start), pa.array(length), ragged(ids, ends, pa.int32())], names=schema.names)

    return map_arrow(frame, cut, schema)


def pack(pieces: DataFrame, capacity: int, length_col: str = "length", cell_items: int = 1 << 15) -> DataFrame:
    """``pieces`` with ``sequence_id`` (any distinct longs) and ``offset``.

    Full pieces stand alone.  Null lengths count as 0, as do negative ones; a
    piece longer than ``capacity`` fails the job; equal pieces are packed each;
    an empty table gives an empty result; input columns named like the two new
    ones give way.  ``cell_items`` bounds what one task packs.  A new
    arrangement of released pieces is taken only if it has fewer bins, and rounds
    go on until one has not or deals to one cell; the driver sees sums only.
    """
    spark = pieces.sparkSession
    ship(spark)
    keep = without(pieces, ["sequence_id", "offset"])
    plain, size, rid = [f"c{k}" for k in range(len(keep))], "size", "rid"
    length = F.greatest(F.coalesce(col(length_col).cast("bigint"), F.lit(0)), F.lit(0))
    length = F.when(length > capacity, F.raise_error(F.lit("a piece is longer than a sequence"))).otherwise(length)
    items = stored(pieces.select(*[col(c).alias(p) for c, p in zip(keep, plain, strict=True)], length.alias(size), F.monotonically_increasing_id().alias(rid)),
                   "pack-items")
    columns = plain
    parts = [items.where(F.col(size) == capacity).select(*columns, (-F.col(rid) - 1).alias("sequence_id"),
                                                         F.lit(0).cast("bigint").alias("offset"))]
    work = items.where(F.col(size) < capacity)
    schema = T.StructType([*work.schema.fields, *[T.StructField(n, T.LongType()) for n in (
        "__cell", "__bin", "__offset", "__free", "__bins", "__bound")]])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([(rid, "ascending")])
        lengths = table.column(size).to_numpy()
        bins, offsets, free = best_fit(lengths, capacity)
        new = [bins, offsets, free[bins], np.full(len(bins), len(free)), np.full(len(bins), bin_bound(lengths, capacity))]
        for name, values in zip(("__bin", "__offset", "__free", "__bins", "__bound"), new, strict=True):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table.select(schema.names)

    def settled(frame: DataFrame, first: int) -> DataFrame:
        number = F.shiftleft(F.lit(first).cast("bigint") + F.col("__cell"), 32) + F.col("__bin")
        return frame.select(*columns, number.alias("sequence_id"), F.col("__offset").alias("offset"))

    n_items, before, old = work.count(), None, None
    turn = first = cells = 0  # cells are numbered through all rounds
    while n_items:
        first, was = first + cells, first
        cells = max(1, -(-n_items // cell_items))
        dealt = work.withColumn("__cell", F.pmod(F.xxhash64(F.col(rid), F.lit(turn)), F.lit(cells)).cast("bigint"))
        packed = stored(dealt.groupBy("__cell").applyInArrow(fit, schema), "pack-round")
        bins = packed.where("__offset = 0").select("__cell", "__bin").distinct().count()
        if before is not None and bins >= before:  # nothing gained: the arrangement of the last round stays
            parts.append(settled(old, was))
            break
        gap = (F.col("__bins") > F.col("__bound")) & (F.col("__free") > 0) | (F.col("__free") * 2 > capacity)
        if cells == 1:
            parts.append(settled(packed, first))
            break
        parts.append(settled(packed.where(~gap), first))
        old = packed.where(gap)
        row = old.agg(F.count(F.lit(1)), F.count_distinct("__cell", "__bin")).first()
        n_items, before = row[0], row[1]
        work = old.select(*columns, size, rid)
        turn += 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.toDF(*keep, "sequence_id", "offset")

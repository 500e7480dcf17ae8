"""Token ids of a corpus as compact binary blocks, in document order.

Ids are numbered anew by how often they occur in the whole corpus, so that
common ids have small numbers, and written in a byte-aligned variable-length
code: one to four little-endian bytes an id, the byte counts apart in control
bytes (two bits an id, four ids a byte).  Decoding looks the control bytes up
in a numpy table and gathers.

A file set is a folder with ``blocks`` (Parquet rows, each one block image) and
``ranks`` (rank -> id).  Spark commits the files, so a lost executor's
blocks are written again and never twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm._common import col, discard, ragged, ship, stored
from tessera.llm._hub import tokenizer

#: Byte counts of the four ids of each control byte.
_LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)


def pack_ids(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    four[:len(v)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes()


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values that ``pack_ids`` coded."""
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros(n, np.uint32)
    for k in range(4):
        there = sizes > k
        out[there] |= raw[at[there] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = 1 << 16, slice_rows: int = 256, special_as_text: bool = True) -> None:
    """Tokenise whole texts, append ``end_id`` to each, and write them in
    ascending ``id_col`` order below ``path``.  Strings of special tokens in a text
    are those tokens unless ``special_as_text``.

    Null and empty texts hold ``end_id`` alone; rows without id come first;
    rows that repeat an id all stay, side by side; an empty table gives an empty
    file set; other columns are not looked at.  Texts are tokenised once: the ids
    are kept in a stored table while the corpus is counted, shuffled once by
    range of (id, row number), and that table is deleted at the end.  Only the
    counts per vocabulary entry reach the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    frame = docs.select(col(id_col).cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        col(text_col).alias("text"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(tokenizer_path, special_as_text)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                ids, offsets = model.encode(part.column(2).to_pylist(), end_id)
                wide = ids.astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4")
                cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [
                    None, pa.py_buffer(offsets * wide.itemsize), pa.py_buffer(wide)])
                width = pa.array(np.full(part.num_rows, wide.itemsize, np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), width, cells.cast(pa.binary())],
                                                 names=["doc_id", "row", "width", "ids"])

    tokens = stored(frame.mapInArrow(tokenise, "doc_id bigint, row bigint, width int, ids binary"), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = np.bincount(np.frombuffer(cell.as_buffer(), f"<u{width}"))
                if len(got) > len(total):
                    got, total = total, got
                total[:len(got)] += got
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["id", "n"])

    counts = (tokens.select("width", "ids").mapInArrow(count, "id bigint, n bigint")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())  # one row per vocabulary entry at most
    ranked = [int(i) for i, _ in sorted(counts, key=lambda r: (-r["n"], r["id"]))]
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked))
    spark.createDataFrame(list(enumerate(ranked)), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "block", "before", "n_ids", "doc_ids", "sizes", "control", "data"]
        part, block, before, count_, docs_, sizes, held = None, 0, 0, 0, [], [], []

        def image() -> pa.RecordBatch:
            nonlocal block, before, count_, docs_, sizes, held
            ids = np.concatenate(held)
            control, data = pack_ids(rank_of[ids])
            row = [part, block, before, len(ids), docs_, np.array(sizes, "<u4").tobytes(), control, data]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            block, before, count_, docs_, sizes, held = block + 1, before + len(ids), 0, [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            columns = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                          batch.column(3), strict=True)
            for part, doc_id, width, cell in columns:
                docs_.append(doc_id)
                held.append(np.frombuffer(cell.as_buffer(), f"<u{width}").astype(np.uint32))
                sizes.append(len(held[-1]))
                count_ += sizes[-1]
                if count_ >= block_ids:
                    yield image()
        if docs_:
            yield image()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (tokens.repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row")
               .select(F.spark_partition_id().alias("part"), "doc_id", "width", "ids"))
    ordered.mapInArrow(blocks, "part int, block bigint, before bigint, n_ids bigint, doc_ids array<bigint>, "
                               "sizes binary, control binary, data binary").write.parquet(f"{path}/blocks")
    discard(tokens)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of a file set; ``start`` counts the ids of all
    documents before.  Blocks are decoded where they are read."""
    ship(spark)
    table = spark.read.parquet(f"{path}/blocks")
    id_of = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.int32)
    # one row per range partition: a window over it stays small at any corpus size
    bases = table.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    frame = table.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("before")).alias("start"), "n_ids", "doc_ids", "sizes", "control", "data")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[unpack_ids(row["control"], row["data"], row["n_ids"])]
                ends = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], "<u4").astype(np.int64))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends[:-1]), ragged(ids, ends, pa.int32())],
                    names=["doc_id", "start", "ids"])

    return frame.mapInArrow(decode, "doc_id bigint, start bigint, ids array<int>")

"""Helpers the operators of this subpackage share: stored intermediate
tables, shipping the package to Python workers, names that cannot clash, and
byte views of Arrow text columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir, ensure_checkpoint_dir, require_checkpoint_dir

#: Characters that count as white space wherever a contract speaks of words.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), "tessera_pkg.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder; Spark removes the
    application's part of it when the driver's JVM ends.  Only a plain local
    session (one machine, as in tests) may fall back to a temporary folder."""
    if checkpoint_dir(spark) is None:
        master = spark.sparkContext.master
        if master == "local" or master.startswith("local["):
            ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tessera-ckpt-"))
    root = f"{require_checkpoint_dir(spark)}/tessera-{spark.sparkContext.applicationId}"
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to a shared Parquet table and read again: cuts the
    lineage, fixes what is not deterministic, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for this very frame; nothing may read it any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of the table that ``maybe_among`` broadcasts, 64 a row.
FILTER_BITS = 1 << 25


def maybe_among(frame: DataFrame, keys: DataFrame, on: list[str], others: bool = False) -> DataFrame:
    """Rows of ``frame`` whose columns ``on`` may be those of a row of ``keys``:
    all that are, and of the rest a share of about (number of keys / ``FILTER_BITS``);
    or, with ``others``, the rows left.

    A join that follows still decides, but shuffles fewer rows of a wide
    frame.  What is broadcast is bounded for any number of keys.
    """
    word, bits, at = hidden(frame, "word"), hidden(frame, "bits"), hidden(frame, "at")
    place = F.pmod(F.xxhash64(*[col(c) for c in on]), F.lit(FILTER_BITS).cast("bigint"))
    words = (keys.select(place.alias(at)).groupBy(F.shiftright(at, 6).alias(word))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({at} & 63 as int))")).alias(bits)))
    marked = frame.withColumn(at, place).withColumn(word, F.shiftright(at, 6)).join(F.broadcast(words), word, "left")
    there = F.coalesce(F.expr(f"bit_get({bits}, cast({at} & 63 as int))"), F.lit(0))
    return marked.where(there == F.lit(0 if others else 1)).select(*[col(c) for c in frame.columns])


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def hidden(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are caseless)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name in taken:
        name += "_"
    return name


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` except those called like ``names``: an
    operator's own result columns replace input columns of the same name."""
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]


def map_arrow(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name (its own lookup trips over dots):
    ``run`` sees and yields columns by position."""
    plain = T.StructType([T.StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=plain.names)

    return frame.toDF(*[f"i{k}" for k in range(len(frame.columns))]).mapInArrow(named, plain).toDF(*schema.names)


def text_slices(text: pa.Array, max_bytes: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of a string
    column with about ``max_bytes`` of text each (one longer text stands
    alone), so that arrays made of them stay in the cache; nulls have no bytes.
    The bytes are a view, not a copy."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string())
    if len(text) == 0:
        return
    if text.null_count:
        text = text.fill_null("")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(text):
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        end = min(max(end, first + 1), len(text))
        a, b = int(offsets[first]), int(offsets[end])
        yield first, end, data[a:b], offsets[first:end + 1] - a
        first = end


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.LargeListArray.from_arrays(pa.array(offsets.astype(np.int64)), pa.array(values)).cast(pa.list_(kind))


def with_crc32(df: DataFrame, ids_col: str = "ids", out_col: str = "ids_crc32") -> DataFrame:
    """``df`` with the unsigned CRC-32 of an id list as little-endian 32-bit integers."""
    ship(df.sparkSession)
    keep = without(df, [out_col])
    frame = df.select(*[col(c) for c in keep], F.coalesce(col(ids_col), F.array().cast("array<int>")).alias(hidden(df, "ids")))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out_col, T.LongType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            offsets = lists.offsets.to_numpy()
            data = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())], names=[*keep, out_col])

    return map_arrow(frame, digest, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalising step of splitmix64: spreads every bit of ``x``."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x

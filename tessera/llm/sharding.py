"""Uniform shuffle of rows into shards of exact size.

A uniform random permutation is cut into shards without ever gathering it:
how many rows of each input partition go to each shard follows a multivariate
hypergeometric law.  The communication matrix (partitions x shards) is drawn
row by row inside the tasks: a binary tree over the partitions splits the
shard sizes exactly, every node has its own seed, and a task walks only its
own path, so no machine holds the matrix and a task that is run again draws
the same row.  Inside a shard rows stand in the order of random keys, which
is dealt out by ranges of the key; counts of the ranges say where each begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, hidden, map_arrow, ship, stored, without

#: Beyond this many items numpy's own sampler refuses.
_NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good items among ``n`` drawn without replacement, for any size.

    Beyond numpy's limit the middle order statistic of the sample is drawn
    first (its position is beta-binomial), which halves the draw each time.
    """
    found = 0
    while n and good and bad and good + bad >= _NUMPY_LIMIT:
        k = (n + 1) // 2
        total = good + bad
        at = k + int(rng.binomial(total - n, rng.beta(k, n - k + 1)))
        if at <= good:  # the first k sampled positions are all good ones
            found, good, n = found + k, good - at, n - k
            bad = total - at - good
        else:  # the sampled positions from the k-th on are all bad ones
            bad, n = at - 1 - good, k - 1
    if n == 0 or good == 0:
        return found
    return found + (n if bad == 0 else int(rng.hypergeometric(good, bad, n)))


def draw_row(sizes: np.ndarray, cells: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Row ``part`` of the communication matrix with row sums ``sizes`` and
    column sums ``cells``."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    lo, hi, left = 0, len(sizes), np.array(cells, dtype=np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        take = int(before[mid] - before[lo])
        if left.sum() < _NUMPY_LIMIT:
            first = rng.multivariate_hypergeometric(left, take, method="marginals").astype(np.int64)
        else:
            first, rest = np.zeros_like(left), int(left.sum())
            for c in range(len(left)):
                rest -= int(left[c])
                first[c] = hypergeometric(rng, int(left[c]), rest, take)
                take -= int(first[c])
        if part < mid:
            hi, left = mid, first
        else:
            lo, left = mid, left - first
    return left


def shard_sizes(n_rows: int, n_shards: int) -> np.ndarray:
    """Rows of each shard; they differ by one at most."""
    return np.array([n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)], np.int64)


def shard_rows(df: DataFrame, n_shards: int, seed: int = 0, block_rows: int = 1 << 14,
               materialise: bool = True) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0
    in each shard): a uniformly random order cut into ``n_shards`` shards whose
    counts differ by one at most.

    Every row counts as itself: nulls, empty texts and repeated rows need no
    care, an empty table gives an empty result, and input columns named
    ``shard`` or ``slot`` give way to the new ones.  About ``block_rows`` rows of a
    shard are permuted at once.  ``materialise=False`` is for inputs whose partitions are the
    same each time they are read (a plain table scan); a task that finds
    another row count than was drawn for fails instead of giving wrong shards.
    The driver sees one count per input partition and nothing else.
    """
    if n_shards < 1 or block_rows < 1:
        raise ValueError("n_shards and block_rows must be positive")
    spark = df.sparkSession
    ship(spark)
    df = df.select(*[col(c) for c in without(df, ["shard", "slot"])])
    if materialise:
        df = stored(df, "shard-input")
    counts = dict(map(tuple, df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()))
    sizes = np.zeros(max(counts, default=-1) + 1, np.int64)
    for p, n in counts.items():
        sizes[p] = n
    total = int(sizes.sum())
    shards = shard_sizes(total, n_shards)
    ranges = -(-shards // block_rows)
    block, key, base = hidden(df, "block"), hidden(df, "key"), hidden(df, "base")
    added = [T.StructField("shard", T.IntegerType()), T.StructField(block, T.LongType()), T.StructField(key, T.LongType())]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng, labels, at = np.random.default_rng([seed, part]), None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if labels is None:
                if part >= len(sizes):
                    raise RuntimeError("the input's partitions changed; use materialise=True")
                labels = np.repeat(np.arange(n_shards, dtype=np.int32), draw_row(sizes, shards, part, seed))
                rng.shuffle(labels)  # permute locally
            mine = labels[at:at + batch.num_rows]
            at += batch.num_rows
            if len(mine) < batch.num_rows:
                raise RuntimeError("the input's partitions changed; use materialise=True")
            keys = rng.integers(0, 2**63, batch.num_rows, dtype=np.int64)
            new = [pa.array(mine), pa.array((keys >> 31) * ranges[mine] >> 32), pa.array(keys)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "shard", block, key])
        if at != (sizes[part] if part < len(sizes) else 0):
            raise RuntimeError("the input's partitions changed; use materialise=True")

    # where each range of keys begins in its shard: the same draws, over rows without columns
    bare = df.select(F.lit(0).alias(base))
    counted = map_arrow(bare, scatter, T.StructType([*bare.schema.fields, *added])).groupBy("shard", block).agg(F.count(F.lit(1)).alias(base))
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(counted.select("shard", block, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(base)), "shard-ranges")
    # the exchange, and the second permutation: rows of a range in the order of their random keys
    dealt = map_arrow(df, scatter, T.StructType([*df.schema.fields, *added]))
    rank = F.row_number().over(Window.partitionBy("shard", block).orderBy(key)) - 1
    out = dealt.join(bases, ["shard", block]).withColumn("slot", rank + F.col(base))
    return out.select(*[col(c) for c in df.columns], "shard", "slot")

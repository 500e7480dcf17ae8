"""Near-duplicate documents by HyperMinHash.

Each document is its set of word shingles.  A sketch has one bucket per hash
function (so that no bucket of a short document stays empty); a bucket keeps
its least hash as a 16-bit register of six bits of leading zeros and ten bits
of mantissa.  Bands of registers propose candidates; the share of equal
registers, corrected for registers that collide by chance, estimates the
similarity; what passes is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import col, maybe_among, ship, stored, text_slices
from tessera.llm._links import near_links
from tessera.llm._shingles import min_hashes, mix64, word_shingles

#: Registers a band, bands; at a similarity of 0.8 a pair meets in no band with probability 3e-6.
BAND_REGISTERS, BANDS = 5, 32
MANTISSA_BITS = 10
#: Standard errors of an estimate by which a pair may fall short before it is dropped.
MARGIN = 4.0


def registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 32-bit minima, in 16 bits."""
    part, exponent = np.frexp(least.astype(np.float64))
    zeros = np.where(least == 0, 32, 32 - exponent).astype(np.uint16)
    mantissa = np.where(least == 0, 0, (part * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.uint16)
    return zeros << np.uint16(MANTISSA_BITS) | mantissa


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two unrelated sets of n and m is equal:
    the sum, over the leading zeros, of both minima falling in one cell."""
    edge = 2.0 ** -np.arange(34)
    n, m = n.astype(float)[:, None], m.astype(float)[:, None]
    power = np.maximum(n + m - 1, 1)
    inside = (1 - edge[None, 1:]) ** power - (1 - edge[None, :-1]) ** power
    return (inside * edge[None, 1:]).sum(1) * (n * m / power)[:, 0] / (1 << MANTISSA_BITS)


def estimate(sig: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows i and j, collisions corrected."""
    out = np.empty(len(i))
    for a in range(0, len(i), 1 << 14):
        x, y = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
        same, by_chance = (sig[x] == sig[y]).mean(1), chance(n[x], n[y])
        out[a:a + (1 << 14)] = (same - by_chance) / (1 - by_chance)
    return out


def unpack(items: pa.Array) -> list[np.ndarray]:
    """Sets kept as bytes of sorted 64-bit values."""
    return [np.frombuffer(x, np.uint64) for x in items.to_pylist()]


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80,
               den: int = 100, materialise: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if den * |both| >= num * |either| for their sets of
    ``words``-word shingles; ``component_id`` is the smallest id that links
    reach, and of each component the row with that id stays.  Defined cases:
    null, empty and blank texts have no shingles and no links; equal sets are
    one class, so copies cost one row; a component without any id has a null
    component_id; of rows that repeat its smallest id one stays; an empty table
    gives an empty result; other columns are not looked at.

    ``materialise=False`` is for inputs that give the same partitions each time
    they are read (a plain table scan): texts of candidates are then read again
    from there instead of a copy.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).alias("text"))
    if materialise:
        base = stored(base, "near-docs")
    base = base.withColumn("rid", F.monotonically_increasing_id())
    functions = BAND_REGISTERS * BANDS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(2)):
                sets = word_shingles(data, offsets, words)
                size = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets)
                starts = (np.cumsum(size) - size)[size > 0]
                x, y = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                sig: list[bytes | None] = [None] * len(sets)
                if len(flat):
                    # two independent sums name the set
                    x[size > 0] = np.add.reduceat(mix64(flat), starts)
                    y[size > 0] = np.add.reduceat(mix64(flat ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    rows = registers(min_hashes(flat, starts, functions))
                    for k, row in zip(np.flatnonzero(size).tolist(), rows, strict=True):
                        sig[k] = row.tobytes()
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(size), pa.array(x.view(np.int64)), pa.array(y.view(np.int64)),
                     pa.array(sig, pa.binary())], names=["doc_id", "rid", "n", "x", "y", "sig"])

    sketches = stored(base.select("doc_id", "rid", "text").mapInArrow(
        sketch, "doc_id bigint, rid bigint, n bigint, x bigint, y bigint, sig binary"), "sketches")
    classes = sketches.where("n > 0").groupBy("n", "x", "y").agg(F.min("rid").alias("cid"))
    nodes = stored(sketches.select("rid", "sig").join(classes.select("cid"), F.col("rid") == F.col("cid"), "left_semi")
                   .select(F.col("rid").alias("cid"), "sig"), "nodes")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                sets = word_shingles(data, offsets, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "n", "items"])

    def sets_of(cids: DataFrame) -> DataFrame:
        texts = maybe_among(base.select(F.col("rid").alias("cid"), "text"), cids, ["cid"]).join(cids.select("cid"), "cid", "left_semi")
        return texts.mapInArrow(full_sets, "cid bigint, n bigint, items binary")

    least = num / den - MARGIN * float(np.sqrt(num / den * (1 - num / den) / functions))
    comp = near_links(nodes, sets_of, unpack, BANDS, 2 * BAND_REGISTERS, num, den, estimate, least, estimate_first=True)

    span = F.lit(str(2**63)).cast("decimal(19,0)")
    order = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), span.cast("decimal(20,0)")) * span + F.col("rid")
    member = (sketches.select("doc_id", "rid", "n", "x", "y").join(classes, ["n", "x", "y"], "left")
              .withColumn("cid", F.coalesce("cid", "rid"))
              .join(comp.withColumnRenamed("node", "cid"), "cid", "left")
              .select("doc_id", "rid", F.col("n").alias("n_shingles"), F.coalesce("comp", "cid").alias("comp"), order.alias("ord")))
    member = stored(member, "members")
    heads = member.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.min("ord").alias("head"))
    return member.join(heads, "comp").select("doc_id", "n_shingles", "component_id", (F.col("ord") == F.col("head")).alias("kept"), "rid")

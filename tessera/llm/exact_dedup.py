"""Exact duplicate removal by progressive refinement.

Documents are grouped by the length of their normalised text, then by a hash
of its beginning, then by SHA-256 of the whole; each step looks only at
groups that still have more than one member.  Only survivors of the first two
steps are read in full again, and only Spark functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import SPACE_CLASS, col, stored


def normalised(text: Column) -> Column:
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: Sequence[Column] = (), prefix_chars: int = 256) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept`` and the
    ``carry`` columns (expressions over ``docs``; they must not be named like
    the result's own).

    Equal texts (after normalising; null is empty) form a group.  The row with
    the smallest id stays.  Defined cases: rows without id stay only if no row
    of the group has one (``keep_id`` is then null); of rows that repeat an id
    and a text, one stays; an empty table gives an empty result; other input
    columns are not looked at.

    Plan: the feature table (id, length, prefix hash) is stored without text.
    Lengths that occur once drop out, then (length, prefix hash) pairs that
    occur once.  The second scan semi-joins texts to the surviving pairs and
    hashes only those in full, so a group of any size is counted by partial
    aggregates and never gathered.
    """
    text = normalised(col(text_col))
    base = docs.select(col(id_col).cast("bigint").alias("doc_id"), text.alias("__norm"), *carry)
    length, head = F.octet_length("__norm"), F.xxhash64(F.substring("__norm", 1, prefix_chars))
    names = [c for c in base.columns if c not in ("doc_id", "__norm")]
    base = base.withColumns({"__len": length, "__head": head})

    features = stored(base.drop("__norm"), "exact-features")
    lengths = features.groupBy("__len").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    heads = (features.join(lengths, "__len", "left_semi")
             .groupBy("__len", "__head").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"))
    heads = stored(heads, "exact-heads")

    alive = (base.join(heads, ["__len", "__head"], "left_semi")
             .select("doc_id", *names, "__len", F.unhex(F.sha2(F.encode("__norm", "UTF-8"), 256)).alias("__full"),
                     F.monotonically_increasing_id().alias("__rid")))
    alive = stored(alive, "exact-alive")
    # id first (null ids last), then the stored row number, in one value that a
    # hash aggregate can take the minimum of
    span = F.lit(str(2**63)).cast("decimal(19,0)")
    order = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), span.cast("decimal(20,0)")) * span + F.col("__rid")
    alive = alive.withColumn("__order", order)
    groups = alive.groupBy("__len", "__full").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.min("__order").alias("__first"))
    grouped = alive.join(groups, ["__len", "__full"]).select(
        "doc_id", "keep_id", "group_size", (F.col("__order") == F.col("__first")).alias("kept"), *names)
    single = features.join(heads, ["__len", "__head"], "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), *names)
    return grouped.unionByName(single)

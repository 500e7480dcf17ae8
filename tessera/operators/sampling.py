"""Sorting, top-k and seeded random picks.

* ``top_k`` is ``orderBy().limit(k)``: Spark plans it as a
  TakeOrderedAndProject (a per-partition heap, then k rows per partition
  merged), never a full sort.
* ``top_k_per_group`` filters ``row_number() <= k``; Spark turns the filter
  into a WindowGroupLimit before the shuffle, so each map task sends at
  most k rows per group, whatever the size of the group.
* Random choices are seeded md5 hashes of the row key: the same in every
  run and every engine, independent of partitioning (``rand(seed)`` is not).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col
from tessera.sources.literals import seeded_fine_hash, seeded_order_key


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    return df.orderBy(*[_col(c) for c in order]).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*[_col(c) for c in order])
    return (df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
            .withColumn(rank, F.col(rank).cast("bigint")))


def random_pick(df: DataFrame, group: Sequence[str], value: str, key: Sequence[str], seed: int,
                out: str | None = None) -> DataFrame:
    """One value per group, uniformly by a seeded hash of ``key`` (partial
    ``min_by`` aggregate)."""
    order = seeded_order_key(seed, *key)
    return df.groupBy(*group).agg(F.min_by(F.col(value), order).alias(out or value))


def random_element(df: DataFrame, group: Sequence[str], array: Column, key: Sequence[str], seed: int,
                   out: str = "value") -> DataFrame:
    """One element per group, uniform over all elements of the arrays held by
    the group's rows (e.g. one word among all words of all texts).

    Exact, with one hash per *row* instead of one per element: a row wins
    with probability proportional to its element count (exponential race
    ``-ln(u) / n``, smallest wins, ties to the smallest key), then a second
    seeded draw picks the position inside the winning row.  Draws have 52 bits
    and are never 0.  The race is a partial hash aggregate of one number per
    group; rows that reach it (one, but for ties) are compared by key.
    ``key`` must identify a row.
    """
    n = F.size(array)
    # empty arrays get a NULL race (try_divide), which min skips
    race = F.try_divide(-F.log(seeded_fine_hash(seed, *key)), n.cast("double"))
    pos = F.floor(seeded_fine_hash(seed + 1, *key) * n).cast("int") + 1
    d = df.withColumns({"_race": race, "_pos": F.least(pos, n)})
    best = d.groupBy(*group).agg(F.min("_race").alias("_best"))
    from tessera.operators.windows import _join_on_keys

    tied = _join_on_keys(d, best, list(group)).where(F.col("_race") == F.col("_best"))
    first = F.row_number().over(Window.partitionBy(*group).orderBy(*key))
    return tied.withColumn("_r", first).where("_r = 1").select(*group, F.element_at(array, F.col("_pos")).alias(out))


def shuffle_deal(df: DataFrame, group: Sequence[str], key: Sequence[str], seed: int, per_group: int,
                 hands: int = 1) -> DataFrame:
    """Shuffle each group by a seeded hash and deal ``per_group`` items
    without replacement, round-robin into ``hands`` disjoint hands."""
    order = seeded_order_key(seed, *key)
    dealt = top_k_per_group(df.withColumn("_order", order), group, ["_order", *key], per_group, "deal_rank")
    hand = F.pmod(F.col("deal_rank") - 1, F.lit(hands)).cast("bigint") + 1
    return dealt.withColumn("hand", hand).drop("_order")

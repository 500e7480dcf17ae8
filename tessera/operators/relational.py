"""Filters, membership joins, lookups, products with constant lists and set
operations.

Membership is always a hash join (``left_semi`` / ``left_anti``) planned by
Catalyst, never a scan of a list per row.  Lookups keep misses as rows with
a ``found`` flag.  Set operations are the distinct forms (``intersect``,
``subtract``); ``A - (A - B)`` is written as ``intersect`` because Catalyst
does not simplify the double difference (two anti joins).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col


# ---- filters --------------------------------------------------------------

def keep_below(df: DataFrame, column: str, border) -> DataFrame:
    """Rows whose value is under ``border`` (pushed to the Parquet scan)."""
    return df.where(F.col(column) < F.lit(border))


def keep_even(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.try_mod(F.col(column), F.lit(2)) == 0)


def keep_in(df: DataFrame, column: str, values: Sequence, negate: bool = False) -> DataFrame:
    cond = F.col(column).isin(list(values))
    return df.where(~cond if negate else cond)


def repeat_rows(df: DataFrame, times, index: str = "rep") -> DataFrame:
    """Each row ``times`` times (rows with fewer than one repeat vanish)."""
    n = _col(times)
    # explode_outer: a plain explode would make Catalyst build the sequence
    # twice (once for an inferred size() > 0 filter)
    return (df.where(n >= 1)
            .withColumn(index, F.explode_outer(F.sequence(F.lit(1), n)))
            .withColumn(index, F.col(index).cast("bigint")))


# ---- joins ----------------------------------------------------------------

def semi_join(left: DataFrame, right: DataFrame, on, negate: bool = False) -> DataFrame:
    """Rows of ``left`` with (or without) a match in ``right``; left rows and
    their duplicates are kept as they are."""
    return left.join(right, on, "left_anti" if negate else "left_semi")


def distinct_semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Distinct rows of ``left`` that have a match in ``right``."""
    return left.distinct().join(right, on, "left_semi")


def lookup(df: DataFrame, dim: DataFrame, left_key, dim_key: str, value_cols: Sequence[str],
           missing: str = "not found") -> DataFrame:
    """Left join to a dimension; a miss keeps its row, gets ``found = false``
    and ``missing`` in string value columns.  Whether the dimension is
    broadcast is Spark's choice, from its measured size."""
    key = _col(left_key)
    d = dim.select(F.col(dim_key).alias("_dim_key"), *value_cols, F.lit(True).alias("_hit"))
    joined = df.join(d, key == F.col("_dim_key"), "left")
    outs = []
    for v in value_cols:
        field = dim.schema[v]
        if field.dataType.simpleString() == "string":
            outs.append(F.coalesce(F.col(v), F.lit(missing)).alias(v))
        else:
            outs.append(F.col(v))
    return joined.select(*[F.col(c) for c in df.columns], *outs,
                         F.coalesce(F.col("_hit"), F.lit(False)).alias("found"))


def with_each(df: DataFrame, name: str, values: Sequence, position: str | None = None) -> DataFrame:
    """Every row once per value of a constant list (``[(r, s) for r in rows
    for s in values]``).

    The list is a literal, so the output is ``len(values)`` times the input
    and grows linearly; a product of two tables is not offered.
    """
    arr = F.array(*[F.lit(v) for v in values])
    if position is None:
        return df.withColumn(name, F.explode(arr))
    out = df.select("*", F.posexplode(arr).alias("_pos", name))
    return out.withColumn(position, (F.col("_pos") + 1).cast("bigint")).drop("_pos")


def presence(probes: DataFrame, probe_col: str, data: DataFrame, data_col, found: str = "found") -> DataFrame:
    """For each distinct probe value: does it occur in ``data``?

    Both sides are reduced to distinct values first (partial aggregation),
    so a repeated value is shuffled once per map task, not once per row.
    """
    values = data.select(_col(data_col).alias("_v")).distinct().withColumn("_hit", F.lit(True))
    p = probes.select(F.col(probe_col)).distinct()
    return (p.join(values, F.col(probe_col) == F.col("_v"), "left")
            .select(probe_col, F.coalesce(F.col("_hit"), F.lit(False)).alias(found)))


# ---- set operations -------------------------------------------------------

def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def double_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """``set(a) - (set(a) - set(b))``, which is ``set(a) & set(b)``."""
    return a.intersect(b)


def double_except_literal(a: DataFrame, b: DataFrame) -> DataFrame:
    """The double difference as written (two anti joins); kept for tests that
    check it equals ``intersect``."""
    return a.subtract(a.subtract(b))


def overlap_report(first: DataFrame, second: DataFrame) -> DataFrame:
    """Reconcile two computations of the same set: sizes and both
    differences as counts (zero differences = they agree).

    One union and one aggregate: each distinct row is tagged with the sides
    it came from (``groupBy`` treats NULLs as equal, as set semantics do).
    """
    cols = first.columns
    tagged = (first.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
              .unionByName(second.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per_row = tagged.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return per_row.agg(
        F.count_if(F.col("_a") == 1).alias("n_first"),
        F.count_if(F.col("_b") == 1).alias("n_second"),
        F.count_if((F.col("_a") == 1) & (F.col("_b") == 0)).alias("only_first"),
        F.count_if((F.col("_a") == 0) & (F.col("_b") == 1)).alias("only_second"),
    )

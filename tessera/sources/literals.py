"""Constant lists and dicts as tables, integer ranges and seeded random values.

Literal tables are small by construction.  Random values are a hash
of (seed, key), so they do not depend on partitioning and a re-run task
produces the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A constant table with a fixed schema (no inference)."""
    return spark.createDataFrame(list(rows), schema)


def dict_table(spark: SparkSession, mapping: Mapping, key: str = "key", value: str = "value",
               key_type: str = "string", value_type: str = "string") -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} {key_type}, {value} {value_type}")


def literal_map(mapping: Mapping) -> Column:
    """A dict as a map literal, for lookups inside a projection (no join)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def int_range(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """Integers ``first..last`` (inclusive), generated in parallel."""
    return spark.range(first, last + 1).select(F.col("id").alias(name))


def int_sequence(first, last) -> Column:
    """Per-row ``range(first, last + 1)``; empty (not counting down) when
    ``last < first``, which is where Spark's ``sequence`` would reverse."""
    a = F.col(first) if isinstance(first, str) else first
    b = F.col(last) if isinstance(last, str) else last
    return F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))


def seeded_unit_hash(seed: int, *keys) -> Column:
    """A number in [0, 1) from md5(seed, keys); equal in every engine with md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string")
                                                for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def seeded_fine_hash(seed: int, *keys) -> Column:
    """A number in (0, 1) from 52 bits of md5(seed, keys), exact in a double."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string")
                                                for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def seeded_choice_step(seed: int, keys: list, start: int, stop: int, step: int) -> Column:
    """``random.randrange(start, stop, step)`` drawn per row from a seeded hash."""
    n = (stop - start + step - 1) // step
    idx = F.floor(seeded_unit_hash(seed, *keys) * n).cast("bigint")
    return (F.lit(start) + idx * F.lit(step)).cast("bigint")


def random_table(spark: SparkSession, n: int, seed: int, columns: Mapping[str, tuple[int, int, int]]) -> DataFrame:
    """``n`` rows, one seeded ``randrange(start, stop, step)`` value per named
    column (``{"a": (0, 50, 5)}``), generated in parallel by ``spark.range``;
    each value depends only on (seed, column, row id)."""
    rows = spark.range(n)
    return rows.select(F.col("id"), *[seeded_choice_step(seed + i, ["id"], *spec).alias(name)
                                      for i, (name, spec) in enumerate(columns.items())])


def seeded_order_key(seed: int, *keys) -> Column:
    """Sort key for a seeded shuffle: md5 text of (seed, keys)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str)
                                                       else k.cast("string") for k in keys]))

"""Array and map expressions (list and dict operations of the reference).

Indexing is NULL-safe: ``try_element_at`` instead of an error when the
index is past the end, so an empty list gives NULL ends.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col


def first_item(c) -> Column:
    return F.try_element_at(_col(c), F.lit(1))


def last_item(c) -> Column:
    return F.try_element_at(_col(c), F.lit(-1))


def nested_item(c, i: int, j: int) -> Column:
    """``m[i][j]`` with 0-based indices, NULL when out of range."""
    return F.get(F.get(_col(c), i), j)


def map_get(m, key) -> Column:
    return F.try_element_at(_col(m), key if isinstance(key, Column) else F.lit(key))


def map_has(m, key) -> Column:
    return F.map_contains_key(_col(m), key if isinstance(key, Column) else F.lit(key))


def sorted_join(values, sep: str = ", ") -> Column:
    """``sep.join(sorted(values))`` for an array column."""
    return F.array_join(F.array_sort(_col(values)), sep)

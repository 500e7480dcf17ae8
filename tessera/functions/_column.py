"""Argument helper shared by the expression and operator modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c) -> Column:
    """A column name, a ``Column`` or a literal value, as a ``Column``."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)

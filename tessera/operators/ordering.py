"""One comparable value for an order of one or two columns.

Spark's hash aggregate can keep the minimum of fixed-width values only: the
minimum of a struct makes it sort every raw row.  Integers, dates and
timestamps are therefore packed into one ``decimal(38,0)``; other types fall
back to a struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HALF, _WHOLE, _LOWEST = 2**63, 2**64, -(2**62)


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock ``timestamp_ntz``."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def whole_number(df: DataFrame, name: str) -> Column | None:
    """The column as a ``bigint`` in the same order, or None for other types."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        return wall_micros(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    return None


def order_value(df: DataFrame, order: Sequence) -> Column:
    """A value that orders rows as ``order`` does, NULLs first.

    Two whole-number columns are packed as ``first * 2**64 + (second + 2**63)``;
    the first must lie within 2**62 of zero (an overflow fails under ANSI mode).
    """
    names = [c for c in order if isinstance(c, str)]
    whole = [whole_number(df, c) for c in names] if len(names) == len(order) <= 2 else [None]
    if any(c is None for c in whole):
        return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    first = F.coalesce(whole[0].cast("decimal(20,0)"), _decimal(_LOWEST if len(whole) == 2 else -_HALF))
    if len(whole) == 1:
        return first.cast("decimal(38,0)")
    second = F.coalesce(whole[1].cast("decimal(20,0)"), _decimal(-_HALF)) + _decimal(_HALF)
    return first * _decimal(_WHOLE) + second


def unpacked(value: Column) -> tuple[Column, Column]:
    """The two whole numbers of a packed order value that came from no NULL."""
    second = F.pmod(value, _decimal(_WHOLE))
    first = F.call_function("div", value - second, _decimal(_WHOLE))
    return first.cast("bigint"), (second - _decimal(_HALF)).cast("bigint")

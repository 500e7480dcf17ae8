"""Validated parsing: every input row ends up accepted or rejected, never lost.

The reference re-prompts until the input parses; a batch has nothing to
re-prompt, so each operator returns the parsed value, an ``is_valid`` flag
and (where there are several rules) a ``reject_reason``.  ``split_rejects``
turns the flag into two outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col
from tessera.functions.numbers import parse_float, parse_int, parse_int_floor
from tessera.functions.strings import split_literal


def split_rejects(df: DataFrame, flag: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by a boolean column; NULL counts as rejected."""
    ok = F.coalesce(F.col(flag), F.lit(False))
    return df.where(ok), df.where(~ok)


def int_list(text, delimiter: str = ",") -> Column:
    """``[int(x) for x in text.split(delimiter)]`` as ``array<bigint>``; a
    part that is not an integer is NULL."""
    return F.transform(split_literal(_col(text), delimiter), parse_int)


def int_list_valid(values) -> Column:
    """The whole record is valid only if every part parsed."""
    return F.forall(_col(values), lambda x: x.isNotNull())


def parse_number(text, kind: str = "int") -> Column:
    """``int(s)``, ``float(s)`` or ``int(floor(float(s)))``; NULL when invalid."""
    fn = {"int": parse_int, "float": parse_float, "int_floor": parse_int_floor}[kind]
    return fn(_col(text))


def move_fields(df, move: str, amount: str, delimiter: str = ","):
    """``df`` with the parsed fields of a ``row<delimiter>col`` move and of an
    amount, each parsed once: ``_n, _a, _b, _amount``."""
    parts = df.withColumn("_parts", split_literal(F.col(move), delimiter))
    return parts.withColumns({
        "_n": F.size("_parts"), "_a": parse_int(F.try_element_at("_parts", F.lit(1))),
        "_b": parse_int(F.try_element_at("_parts", F.lit(2))), "_amount": parse_int_floor(F.col(amount))}).drop("_parts")


def _move(n: Column, a: Column, b: Column, size) -> Column:
    return (F.when(n < 2, F.lit("too_few"))
            .when(n > 2, F.lit("too_many"))
            .when(a.isNull() | b.isNull(), F.lit("not_integer"))
            .when(F.least(a, b) < 1, F.lit("too_low"))
            .when(F.greatest(a, b) > _col(size), F.lit("too_high"))
            .otherwise(F.lit("ok")))


def _amount(value: Column, limit) -> Column:
    return (F.when(value.isNull(), F.lit("not_number"))
            .when(value < 0, F.lit("negative"))
            .when(value > _col(limit), F.lit("above_limit"))
            .otherwise(F.lit("ok")))


def move_reason(text, size, delimiter: str = ",") -> Column:
    """Reason a ``row<delimiter>col`` move is rejected, or ``ok``: exactly two
    fields, both integers, each in 1..size, checked in this order."""
    parts = split_literal(_col(text), delimiter)
    return _move(F.size(parts), parse_int(F.try_element_at(parts, F.lit(1))), parse_int(F.try_element_at(parts, F.lit(2))), size)


def move_reason_of(size) -> Column:
    """``move_reason`` of fields parsed by ``move_fields``."""
    return _move(F.col("_n"), F.col("_a"), F.col("_b"), size)


def amount_reason(amount_text, limit) -> Column:
    """Reason an amount (text) is rejected against the limit held by the row:
    not a number, negative, above the limit, or ``ok``."""
    return _amount(parse_int_floor(_col(amount_text)), limit)


def amount_reason_of(limit) -> Column:
    """``amount_reason`` of an amount parsed by ``move_fields``."""
    return _amount(F.col("_amount"), limit)

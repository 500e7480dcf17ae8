"""Number expressions with Python's arithmetic semantics.

Python's ``%`` and ``//`` floor towards minus infinity; Spark's ``%`` and
``div`` truncate towards zero, and ``pmod(7, -3)`` is 1 where Python gives
-2.  A zero divisor gives NULL here (``try_`` functions) instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col


# Text accepted by Python's int() and float() (underscore
# digit groups aside); checked first because Spark's casts differ
# ('5d' casts to 5.0, '1.5' may cast to an integer).
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


def floor_mod(a, b) -> Column:
    """Python ``a % b``: the result has the sign of the divisor."""
    a, b = _col(a), _col(b)
    return F.try_mod(F.try_mod(a, b) + b, b)


def floor_div(a, b) -> Column:
    """Python ``a // b`` for integers."""
    a, b = _col(a), _col(b)
    return F.when(b == 0, F.lit(None)).otherwise(
        F.try_divide(a - floor_mod(a, b), b).cast("bigint")
    )


def divmod_pair(a, b) -> Column:
    """``divmod(a, b)`` for integers as ``struct(quotient, remainder)``."""
    return F.struct(floor_div(a, b).alias("quotient"), floor_mod(a, b).alias("remainder"))


def is_multiple(a, b) -> Column:
    """``a`` is a multiple of ``b`` (0 is a multiple of everything; b = 0 gives NULL)."""
    return floor_mod(a, b) == 0


def parse_int(c) -> Column:
    """``int(text)``, NULL when Python would raise."""
    s = _col(c)
    return F.when(s.rlike(INT_TEXT), F.trim(s).try_cast("bigint"))


def parse_float(c) -> Column:
    """``float(text)``, NULL when Python would raise."""
    s = _col(c)
    return F.when(s.rlike(FLOAT_TEXT), F.trim(s).try_cast("double"))


def parse_int_floor(c) -> Column:
    """``int(math.floor(float(text)))``."""
    return F.floor(parse_float(c)).cast("bigint")


def round_half_even(c, scale: int = 0) -> Column:
    """Python's ``round``: half to even (Spark's ``round`` is half up)."""
    return F.bround(_col(c), scale)


def to_cents(c) -> Column:
    """Money as exact integer cents, so that sums do not drift."""
    return F.round(_col(c) * 100).cast("bigint")


def clamp(c, lo=None, hi=None) -> Column:
    out = _col(c)
    if lo is not None:
        out = F.greatest(out, _col(lo))
    if hi is not None:
        out = F.least(out, _col(hi))
    return out


def year_at_age(age, as_of=None, target_age: int = 100) -> Column:
    """Calendar year in which someone of ``age`` (at ``as_of``) turns ``target_age``."""
    as_of_col = F.current_date() if as_of is None else F.to_date(_col(as_of))
    return (F.year(as_of_col) + (F.lit(target_age) - _col(age))).cast("bigint")


def number_class(c, divisor) -> Column:
    """First matching rule: multiple of 4, even, multiple of ``divisor``, odd.

    Non-integral numbers get ``not_integer`` (Python would call them odd).
    """
    x = _col(c)
    integral = x == F.floor(x)
    return (
        F.when(~integral, F.lit("not_integer"))
        .when(is_multiple(x, 4), F.lit("multiple_of_4"))
        .when(is_multiple(x, 2), F.lit("even"))
        .when(F.coalesce(is_multiple(x, divisor), F.lit(False)), F.lit("multiple_of_divisor"))
        .otherwise(F.lit("odd"))
    )


def _whole_root(x: Column) -> Column:
    """The largest whole number whose square is not above ``x``."""
    # the double root may be one off beyond 2**53: corrected in whole numbers
    guess = F.floor(F.sqrt(x)).cast("bigint")
    wide = guess.cast("decimal(20,0)")
    return F.when(wide * wide > x, guess - 1).when((wide + 1) * (wide + 1) <= x, guess + 1).otherwise(guess)


def divisors(n) -> Column:
    """All divisors of ``n`` (n >= 1) in ascending order, NULL below 1; for numbers of at most
    about 10**12 (an array of the candidates up to the root; ``divisors_of`` has no such bound).

    Trial division up to sqrt(n) only; the partner of each small divisor
    supplies the large ones.
    """
    x = _col(n).cast("bigint")
    root = _whole_root(x)
    small = F.filter(F.sequence(F.lit(1).cast("bigint"), F.greatest(root, F.lit(1).cast("bigint"))),
                     lambda d: F.try_mod(x, d) == 0)
    large = F.transform(small, lambda d: F.call_function("div", x, d))
    return F.when(x >= 1, F.array_sort(F.array_distinct(F.concat(small, large))))


#: Candidates that one row tries when ``divisors_of`` looks for divisors.
DIVISOR_BLOCK = 1 << 16


def divisors_of(df, column: str, out: str = "divisor"):
    """One row per distinct number (at least 1) and divisor: ``column, out``.

    The candidates up to the root of a number are cut into blocks of
    ``DIVISOR_BLOCK``, one row each, odd ones only for an odd number, so a number near
    2**63 is spread over tasks and no array is larger than a block.
    """
    x = F.col(column)
    numbers_ = df.where(x >= 1).select(x.cast("bigint").alias(column)).distinct().withColumn("_root", _whole_root(x))
    step = F.when(x % 2 == 1, 2).otherwise(1).cast("bigint")
    blocks = numbers_.select(column, "_root", step.alias("_step"), F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.col("_root"), F.lit(DIVISOR_BLOCK).cast("bigint"))).alias("_from"))
    blocks = blocks.repartition(column, "_from")
    last = F.least(F.col("_from") + (DIVISOR_BLOCK - 1), F.col("_root"))  # blocks begin at odd numbers
    small = blocks.select(column, F.explode(F.filter(F.sequence("_from", last, "_step"), lambda d: F.col(column) % d == 0)).alias("_d"))
    partner = F.call_function("div", F.col(column), F.col("_d"))
    both = F.when(partner == F.col("_d"), F.array("_d")).otherwise(F.array(F.col("_d"), partner))
    return small.select(column, F.explode(both).alias(out))


# ---- Fibonacci terms of any size ---------------------------------------------
# A term is an array of limbs in base 10**9, lowest first; products of limbs are summed as decimal(38,0).

_BASE, _LIMB_DIGITS = 10**9, 9
_WIDE = "decimal(38,0)"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once (a lambda that names an
    outer expression works it out again for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _carried(raw: Column) -> Column:
    """Limbs (array<bigint>) of the number whose limbs, of any size and sign, are ``raw``."""
    base = F.lit(_BASE).cast(_WIDE)
    zero = F.struct(F.array().cast("array<bigint>").alias("limbs"), F.lit(0).cast(_WIDE).alias("carry"))

    def step(acc, x):
        return _let((x + acc["carry"]).cast(_WIDE), lambda v: F.struct(
            F.array_append(acc["limbs"], F.pmod(v, base).cast("bigint")).alias("limbs"),
            F.call_function("div", (v - F.pmod(v, base)).cast(_WIDE), base).cast(_WIDE).alias("carry")))

    full = F.aggregate(F.concat(raw, F.array(*[F.lit(0).cast(_WIDE)] * 4)), zero, step)["limbs"]
    return _let(full, lambda limbs: F.slice(limbs, F.lit(1), F.array_max(F.transform(limbs, lambda x, i: F.when(x != 0, i + 1).otherwise(1)))))


def _product(a: Column, b: Column) -> Column:
    """Uncarried limbs (array<decimal(38,0)>) of a product."""
    def limb(k):
        pairs = F.sequence(F.greatest(F.lit(0), k - F.size(b) + 1), F.least(k, F.size(a) - 1))
        return F.aggregate(pairs, F.lit(0).cast(_WIDE), lambda acc, i: (
            acc + (F.get(a, i).cast("decimal(19,0)") * F.get(b, k - i).cast("decimal(19,0)")).cast(_WIDE)).cast(_WIDE))

    return F.transform(F.sequence(F.lit(0), F.size(a) + F.size(b) - 2), limb)


def _sum(a: Column, b: Column, times_a: int = 1, times_b: int = 1) -> Column:
    """Uncarried limbs of ``times_a * a + times_b * b``."""
    return F.zip_with(a, b, lambda x, y: (F.coalesce(x, F.lit(0)).cast(_WIDE) * times_a + F.coalesce(y, F.lit(0)).cast(_WIDE) * times_b).cast(_WIDE))


def fibonacci_text(n) -> Column:
    """The digits of the n-th term of 1, 1, 2, 3, 5, ..., of any size; NULL below 1.

    Fast doubling, one step per bit of ``n``: ``F(2k) = F(k) (2 F(k+1) - F(k))`` and
    ``F(2k+1) = F(k)**2 + F(k+1)**2``.
    """
    x = _col(n).cast("int")
    number = F.when(x >= 1, x).otherwise(1)
    one, nought = F.array(F.lit(1).cast("bigint")), F.array(F.lit(0).cast("bigint"))

    def double(acc, bit):
        a, b = acc["a"], acc["b"]
        c = _let(_sum(b, a, 2, -1), lambda twice: _carried(_product(a, twice)))
        pair = F.struct(c.alias("c"), _carried(_sum(_product(a, a), _product(b, b))).alias("d"))
        odd = F.call_function("shiftright", number, bit) % 2 == 1
        return _let(pair, lambda p: F.when(odd, F.struct(p["d"].alias("a"), _carried(_sum(p["c"], p["d"])).alias("b")))
                    .otherwise(F.struct(p["c"].alias("a"), p["d"].alias("b"))))

    bits = F.sequence(F.length(F.bin(number)).cast("int") - 1, F.lit(0), F.lit(-1))
    limbs = F.aggregate(bits, F.struct(nought.alias("a"), one.alias("b")), double)["a"]
    padded = F.transform(limbs, lambda v: F.lpad(v.cast("string"), _LIMB_DIGITS, "0"))
    return F.when(x >= 1, F.ltrim(F.array_join(F.reverse(padded), ""), F.lit("0")))


def fibonacci_of(df, column: str, out: str = "fib"):
    """``df`` with the digits of the ``column``-th term of 1, 1, 2, 3, 5, ... as text, of any
    size; NULL below 1.  A term is worked out once per distinct number and joined,
    not once per row."""
    wanted = df.select(F.col(column).alias("_n")).where(F.col("_n") >= 1).distinct()
    terms = wanted.select("_n", fibonacci_text("_n").alias(out))
    return df.join(terms, F.col(column) == F.col("_n"), "left").drop("_n")


def fibonacci(n) -> Column:
    """n-th term of 1, 1, 2, 3, 5, ... as decimal(38,0) (``fibonacci_text`` has
    no such bound); NULL below 1."""
    x = _col(n)
    zero = F.lit(0).cast("decimal(38,0)")
    one = F.lit(1).cast("decimal(38,0)")
    start = F.struct(zero.alias("a"), one.alias("b"))
    steps = F.sequence(F.lit(1), F.greatest(x, F.lit(1)))
    state = F.aggregate(
        steps, start,
        lambda acc, _: F.struct(acc["b"].alias("a"), (acc["a"] + acc["b"]).cast("decimal(38,0)").alias("b")),
    )
    return F.when(x >= 1, state["a"])


def fibonacci_terms(n) -> Column:
    """The first ``n`` terms 1, 1, 2, 3, ... as ``array<decimal(38,0)>``;
    empty when ``n`` is below 1 (one pass, no per-term recomputation)."""
    x = _col(n)
    zero = F.lit(0).cast("decimal(38,0)")
    one = F.lit(1).cast("decimal(38,0)")
    start = F.struct(zero.alias("a"), one.alias("b"), F.array().cast("array<decimal(38,0)>").alias("terms"))
    steps = F.sequence(F.lit(1), F.greatest(x, F.lit(1)))
    state = F.aggregate(
        steps, start,
        lambda acc, _: F.struct(acc["b"].alias("a"), (acc["a"] + acc["b"]).cast("decimal(38,0)").alias("b"),
                                F.array_append(acc["terms"], acc["b"]).alias("terms")),
    )
    return F.when(x >= 1, state["terms"]).otherwise(F.array().cast("array<decimal(38,0)>"))

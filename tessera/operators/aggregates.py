"""Counts, distinct values, uniform groups, board lines and pivots.

All of these are hash aggregates with a partial (map-side) step, so a
value that holds a large share of the rows is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions._column import as_column as _col
from tessera.functions.strings import slice_both_ends
from tessera.operators.ordering import order_value, unpacked

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def value_counts(df: DataFrame, value: str, position: Sequence[str], count: str = "n",
                 first_prefix: str = "first_", rank: str | None = None) -> DataFrame:
    """Occurrences per distinct value and where it was first seen.

    ``position`` columns (e.g. ``doc_id, line_no``) order the input; the
    first position is returned as ``first_<col>`` columns.  With ``rank``,
    the values are also numbered 1.. by first appearance (the dict-counter
    iteration order) with a distributed global ordinal, never a window over
    all values in one partition.
    """
    ordinal = order_value(df, position)
    agg = df.groupBy(value).agg(F.count("*").alias(count), F.min(ordinal).alias("_first"))
    if len(position) == 2 and all(isinstance(df.schema[c].dataType, _WHOLE) for c in position):
        parts = unpacked(F.col("_first"))  # the positions are never NULL
    elif len(position) == 1 and isinstance(df.schema[position[0]].dataType, _WHOLE):
        parts = [F.col("_first")]
    else:
        agg = df.groupBy(value).agg(F.count("*").alias(count), F.min(F.struct(*position)).alias("_first"))
        parts = [F.col("_first")[c] for c in position]
    firsts = [p.cast(df.schema[c].dataType).alias(first_prefix + c) for p, c in zip(parts, position, strict=True)]
    out = agg.select(value, count, *firsts)
    if rank is not None:
        from tessera.operators.windows import global_ordinal
        out = global_ordinal(out, [first_prefix + c for c in position], rank)
    return out


def sliced_counts(df: DataFrame, text: str, head: int, tail: int, out: str = "key",
                  count: str = "n") -> DataFrame:
    """Count per text with ``head`` characters cut from the start and
    ``tail`` from the end."""
    return df.groupBy(slice_both_ends(F.col(text), head, tail).alias(out)).agg(F.count("*").alias(count))


def count_matching(df: DataFrame, keys: Sequence[str], cond: Column, out: str = "n") -> DataFrame:
    """Occurrences of one value (a condition) per key; keys with none get 0."""
    return df.groupBy(*keys).agg(F.count_if(cond).cast("bigint").alias(out))


def occurrence_split(df: DataFrame, keys: Sequence[str], out: str = "occurrences") -> DataFrame:
    """Every row with the number of rows sharing its key and ``kind``
    (``repeated`` / ``single``).  One partial aggregate and a join back;
    not a count per element (quadratic) and not a window over a hot key."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias(out))
    from tessera.operators.windows import _join_on_keys

    joined = _join_on_keys(df, counts, keys)  # a NULL key is a key like any other
    return joined.withColumn("kind", F.when(F.col(out) > 1, F.lit("repeated")).otherwise(F.lit("single")))


def first_seen_distinct(df: DataFrame, group: Sequence[str], value: str, order: Sequence,
                        first_id: str | None = None, rank: str = "seen_rank",
                        chunk_rows: int | None = None) -> DataFrame:
    """Distinct values per group, in first-seen order.

    The first occurrence is a partial hash aggregate of one order value; the
    rank runs over the *distinct* values of a group (one row per value), not
    over the raw rows.  With ``chunk_rows`` groups of many distinct values are
    numbered by the segmented scan.
    """
    group = list(group)
    d = df.withColumn("_ord", order_value(df, order))
    firsts = d.groupBy(*group, value).agg(F.min("_ord").alias("_first"))
    if chunk_rows is None:
        w = Window.partitionBy(*group).orderBy("_first")
        out = firsts.withColumn(rank, F.row_number().over(w).cast("bigint"))
    else:
        from tessera.operators.windows import Segments, row_numbers
        out = row_numbers(firsts, group, [F.col("_first")], rank, segments=Segments(chunk_rows=chunk_rows))
    cols = [*group, value, rank]
    if first_id is not None:
        # the last order column is the unique id of the row
        kind = df.schema[order[-1]].dataType
        packed = isinstance(out.schema["_first"].dataType, T.DecimalType)
        last = (unpacked(F.col("_first"))[1] if len(order) == 2 else F.col("_first")) if packed else F.col("_first")[order[-1]]
        out = out.withColumn(first_id, last.cast(kind))
        cols.insert(len(group) + 1, first_id)
    return out.select(*cols)


def max_per_key(df: DataFrame, keys: Sequence[str], value, out: str = "max_value") -> DataFrame:
    """Largest value per key; an empty group gives NULL (the reference starts
    from -inf)."""
    return df.groupBy(*keys).agg(F.max(_col(value)).alias(out))


def uniform_groups(df: DataFrame, grouping_sets: Sequence[Sequence[str]], value: str,
                   min_rows: int = 2, level: str = "level", count: str = "n") -> DataFrame:
    """Groups (over several grouping sets) whose ``value`` is the same on
    every row and not empty, with at least ``min_rows`` rows.

    ``level`` is the grouping id (a bit per column left out, as in SQL).
    """
    all_cols = []
    for gs in grouping_sets:
        for c in gs:
            if c not in all_cols:
                all_cols.append(c)
    # per value first (hash, partial): a group is uniform if it has one value
    per = df.groupBy(*all_cols, value).agg(F.count("*").alias("_n"))
    sets = [[F.col(c) for c in gs] + [F.col(value)] for gs in grouping_sets]
    g = per.groupingSets(sets, *[F.col(c) for c in all_cols], F.col(value)).agg(
        F.grouping_id(*[F.col(c) for c in all_cols], F.col(value)).cast("bigint").alias(level), F.sum("_n").alias(count))
    g = g.withColumn(level, F.shiftright(level, 1))  # the value itself is in every set
    kinds = g.groupBy(*all_cols, level).agg(F.count("*").alias("_k"))
    keep = (F.col("_k") == 1) & (F.col(count) >= min_rows) & F.col(value).isNotNull() & (F.col(value) != F.lit(""))
    from tessera.operators.windows import _join_on_keys

    joined = _join_on_keys(g, kinds, [*all_cols, level])
    return joined.where(keep).select(*all_cols, level, value, count)


def board_lines(cells: DataFrame, board: Sequence[str], row: str, col: str, value: str, size: int,
                empty=0, cells_col: str | None = None) -> DataFrame:
    """Rows, columns and both diagonals of square boards that are complete,
    uniform and not empty: ``board + [kind, line, winner]``.

    With ``cells_col`` the frame has one row a board, and that column is the
    array of its cells (structs of ``row``, ``col`` from 0 to ``size - 1`` and
    ``value``): lines are then read off row by row, without an aggregate.
    Otherwise each cell is a row; it is tagged with every line it lies on by one ``explode`` of a
    literal-size array (at most four tags), then one aggregate per line.
    """
    board = list(board)
    if cells_col is not None:
        def at(field: str, k: int):  # a second parameter of the lambda itself would be the element's index
            return lambda x: x[field] == k

        kinds = [("row", k, at(row, k)) for k in range(size)] + [("col", k, at(col, k)) for k in range(size)]
        kinds += [("diag", 0, lambda x: x[row] == x[col]), ("anti", 0, lambda x: x[row] + x[col] == size - 1)]
        found = F.array(*[F.struct(
            F.lit(kind).alias("kind"), F.lit(k).cast("bigint").alias("line"),
            F.transform(F.filter(F.col(cells_col), on), lambda x: x[value]).alias("vs")) for kind, k, on in kinds])
        full = F.filter(found, lambda x: (F.size(x["vs"]) == size) & (F.array_min(x["vs"]) == F.array_max(x["vs"]))
                        & (F.array_min(x["vs"]) != F.lit(empty)))
        # a board of fewer cells has no line
        lines = cells.where(F.size(cells_col) >= size).select(*board, F.explode(full).alias("_t"))
        return lines.select(*board, "_t.kind", "_t.line", F.array_min("_t.vs").alias("winner"))
    r, c = F.col(row), F.col(col)
    tags = F.array(
        F.struct(F.lit("row").alias("kind"), r.cast("bigint").alias("line")),
        F.struct(F.lit("col").alias("kind"), c.cast("bigint").alias("line")),
        F.when(r == c, F.struct(F.lit("diag").alias("kind"), F.lit(0).cast("bigint").alias("line"))),
        F.when(r + c == size - 1, F.struct(F.lit("anti").alias("kind"), F.lit(0).cast("bigint").alias("line"))),
    )
    tagged = cells.select(*board, F.col(value).alias("_v"), F.explode(tags).alias("_t")).where(
        F.col("_t").isNotNull())
    lines = tagged.groupBy(*board, F.col("_t.kind").alias("kind"), F.col("_t.line").alias("line")).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    win = (F.col("_n") == size) & (F.col("_lo") == F.col("_hi")) & (F.col("_lo") != F.lit(empty))
    return lines.where(win).select(*board, "kind", "line", F.col("_lo").alias("winner"))


def board_outcomes(cells: DataFrame, board: Sequence[str], row: str, col: str, value: str, size: int,
                   empty=0) -> DataFrame:
    """Per board: ``has_line`` (any uniform, complete, non-empty line) and
    ``winner`` (the value of those lines when they all agree, else NULL).
    Boards without a line are kept with ``has_line = false``."""
    board = list(board)
    lines = board_lines(cells, board, row, col, value, size, empty)
    per_board = lines.groupBy(*board).agg(F.min("winner").alias("_lo"), F.max("winner").alias("_hi"))
    boards = cells.select(*board).distinct()
    joined = boards.join(per_board, board, "left")
    return joined.select(*board, F.col("_lo").isNotNull().alias("has_line"),
                         F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("winner"))


def pivot_counts(df: DataFrame, row_key, col_key, col_values: Sequence, names: Sequence[str] | None = None,
                 ) -> DataFrame:
    """Counts of ``row_key`` x ``col_key`` with one column per listed value
    (transpose of the long form).  The value list is given, so Spark needs no
    extra job to find it; missing cells are 0."""
    names = list(names or [str(v) for v in col_values])
    rk = _col(row_key)
    ck = _col(col_key)
    aggs = [F.count_if(ck == F.lit(v)).cast("bigint").alias(n) for v, n in zip(col_values, names)]
    return df.groupBy(rk).agg(*aggs)

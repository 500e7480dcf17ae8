"""Ordered per-key operators: running totals, previous values, first
occurrences, first-claim-wins, turn parity, progress to completion, ends.

Scale rule: a key (user, day, game) may hold a large share of all rows, so
no operator here puts a whole key into one window partition.

* Running sums and the previous value are *segmented scans*: rows are cut
  into chunks along the order (``Segments``), the window runs per (key,
  chunk), and a small table of per-chunk totals gives each chunk its offset.
  Chunks are cut at row ranks, not at equal widths: a seeded hash of the order
  columns samples about ``OVERSAMPLE`` rows for each chunk of a key, and every
  ``OVERSAMPLE``-th of them is a cut, so a burst at one timestamp is split by
  the columns that break its ties.  Keys with few rows have no cut.
* First occurrences are an aggregate (partial, map-side, on one packed order
  value, so that it hashes) plus a join back; the aggregate side has one row
  per group, so AQE can split a skewed join partition of the large side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tessera.functions._column import as_column as _col
from tessera.operators.ordering import order_value


def _order_cols(order: Sequence) -> list[Column]:
    return [_col(c) for c in order]


def _join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on same-named key columns (right keys dropped)."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Key columns that are never NULL, for partitioning and joining.

    A nullable key ``k`` becomes ``(coalesce(k, default), isnull(k))``: equal
    pairs mean equal keys, NULL included.  The segmented scans partition the
    window by these columns and join the chunk offsets on the same columns
    with a plain equi-join, so the join reuses the window's partitioning and
    only the small offsets table is shuffled (a NULL-safe join condition
    would make Spark shuffle the large side again).
    """
    out = []
    for k in keys:
        field = df.schema[k]
        if not field.nullable:
            out.append(k)
            continue
        dt = field.dataType
        if isinstance(dt, T.StringType):
            default = F.lit("")
        elif isinstance(dt, T.BooleanType):
            default = F.lit(False)
        elif isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            default = F.lit("1970-01-01").cast(dt)
        elif isinstance(dt, T.NumericType):
            default = F.lit(0).cast(dt)
        else:
            raise TypeError(f"key {k} of type {dt.simpleString()} is not supported")
        df = df.withColumn(f"_nk_{k}", F.coalesce(F.col(k), default)).withColumn(f"_nn_{k}", F.col(k).isNull())
        out += [f"_nk_{k}", f"_nn_{k}"]
    return df, out


# ---- segmented scans ------------------------------------------------------

def wall_seconds(ts) -> Column:
    """Seconds since 1970-01-01 00:00 of a wall-clock ``timestamp_ntz``.  No
    time zone is involved, so it never goes backwards along the timestamp
    (for a zoned ``timestamp`` use ``epoch_seconds``)."""
    t = _col(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def minute_bucket(ts) -> Column:
    """Minutes since 1970-01-01 of a wall-clock timestamp, for use as a chunk."""
    return F.floor(wall_seconds(ts) / 60).cast("bigint")


#: Sampled rows for each chunk; more of them make chunks more even.
OVERSAMPLE = 16


@dataclass(frozen=True)
class Segments:
    """How a segmented scan cuts the rows of a key into chunks.

    * ``chunk_rows``: about this many rows a chunk, whatever the spread of the
      rows along the order; a key of more than ``max_chunks`` times as many gets
      that many chunks, evenly larger ones, so its table of cuts is bounded;
    * ``chunk``: or an explicit chunk number that never decreases along the
      order (a day, a block of positions).
    """

    chunk: Column | None = None
    chunk_rows: int = 250_000
    max_chunks: int = 1024


def _with_chunk(df: DataFrame, keys: Sequence[str], order: Sequence, seg: Segments, is_cut: str | None = None) -> DataFrame:
    """Add ``_chunk`` (bigint, never NULL) as described by ``seg``, and ``is_cut``:
    does the row's key have cuts at all?

    The sampled rows of a key (``OVERSAMPLE`` / ``chunk_rows`` of its rows) become
    one sorted array of cuts; keys without a cut have no row in that table.
    Of a very large key the sampled rows with the smallest hashes are taken, a limit
    per key that holds in each map task, so no array grows with the key.
    Each row finds its chunk by a binary search in its key's array.  No count
    and no job runs beforehand; AQE sees how small the table is.
    """
    if seg.chunk is not None:
        # a NULL order value sorts first (ascending), so its chunk comes first too
        return df.withColumn("_chunk", F.coalesce(seg.chunk.cast("bigint"), F.lit(-(2 ** 63)).cast("bigint")))
    every = max(1, seg.chunk_rows // OVERSAMPLE)
    step = max(1, seg.chunk_rows // every)
    d = df.withColumn("_ord", order_value(df, order))
    sampled = d.where(F.pmod(F.xxhash64("_ord"), F.lit(every)) == 0)
    smallest = Window.partitionBy(*keys).orderBy(F.xxhash64("_ord", F.lit(1)), "_ord")
    sampled = (sampled.select(*keys, "_ord").withColumn("_rn", F.row_number().over(smallest))
               .where(F.col("_rn") <= seg.max_chunks * step))
    cuts = sampled.groupBy(*keys).agg(F.array_sort(F.collect_list("_ord")).alias("_s"))
    cuts = cuts.select(*keys, F.filter("_s", lambda _, i: (i + 1) % step == 0).alias("_cuts")).where(F.size("_cuts") > 0)
    tagged = _join_on_keys(d, cuts, keys, "left")
    size = F.size("_cuts")
    # number of cuts below or at the row, found from the highest bit down
    below = F.aggregate(
        F.array(*[F.lit(1 << b) for b in range(24, -1, -1)]), F.lit(0),
        lambda at, b: F.when((at + b <= size) & (F.get("_cuts", at + b - 1) <= F.col("_ord")), at + b).otherwise(at))
    chunk = F.when(F.col("_cuts").isNotNull(), below).otherwise(0).cast("bigint")
    if is_cut is not None:
        tagged = tagged.withColumn(is_cut, F.col("_cuts").isNotNull())
    return tagged.withColumn("_chunk", chunk).drop("_ord", "_cuts")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence, sums: Mapping[str, Column],
                 exclusive: bool = False, segments: Segments | None = None) -> DataFrame:
    """Add one running sum per entry of ``sums`` (name -> value column).

    Rows are ordered by ``order`` inside each key (``order`` must be a total
    order, e.g. end with a unique id).  ``exclusive`` sums the rows strictly
    before.  With ``segments`` the scan is segmented (see module doc),
    without it a plain window is used.
    """
    keys = list(keys)
    ordc = _order_cols(order)
    upper = -1 if exclusive else 0
    if segments is None:
        w = Window.partitionBy(*keys).orderBy(*ordc).rowsBetween(Window.unboundedPreceding, upper)
        out = df
        for name, value in sums.items():
            out = out.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))
        return out

    d = _with_chunk(df, keys, order, segments)
    d, pk = _non_null_keys(d, keys)
    part = pk + ["_chunk"]
    w = Window.partitionBy(*part).orderBy(*ordc).rowsBetween(Window.unboundedPreceding, upper)
    local = d
    for i, (name, value) in enumerate(sums.items()):
        local = local.withColumn(f"_v{i}", value).withColumn(
            f"_l{i}", F.coalesce(F.sum(f"_v{i}").over(w), F.lit(0)))
    # per-chunk totals (partial aggregate), then the offset of each chunk is
    # the sum of the chunks before it: a window over one row per chunk
    totals = local.groupBy(*part).agg(*[F.sum(f"_v{i}").alias(f"_t{i}") for i in range(len(sums))])
    before = Window.partitionBy(*pk).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}")
                                     for i in range(len(sums))])
    joined = local.join(offsets, part)
    for i, name in enumerate(sums):
        joined = joined.withColumn(name, F.col(f"_o{i}") + F.col(f"_l{i}"))
    drop = ["_chunk"] + [c for c in pk if c not in keys] + [f"_{p}{i}" for i in range(len(sums)) for p in "vlo"]
    return joined.drop(*drop)


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence, value: str, out: str,
                   segments: Segments | None = None) -> DataFrame:
    """``out`` = ``value`` of the previous row of the same key (NULL for the first)."""
    keys = list(keys)
    ordc = _order_cols(order)
    if segments is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*ordc)))
    d = _with_chunk(df, keys, order, segments)
    d, pk = _non_null_keys(d, keys)
    part = pk + ["_chunk"]
    w = Window.partitionBy(*part).orderBy(*ordc)
    local = d.withColumn("_rn", F.row_number().over(w)).withColumn("_lag", F.lag(value).over(w))
    # the last row of each chunk is the one without a next row: no aggregate
    lasts = (d.withColumn("_next", F.lead(F.lit(True)).over(w)).where(F.col("_next").isNull())
             .select(*part, F.col(value).alias("_last")))
    prev = lasts.select(*part, F.lag("_last").over(Window.partitionBy(*pk).orderBy("_chunk")).alias("_prev"))
    joined = local.join(prev, part)
    drop = ["_chunk", "_rn", "_lag", "_prev"] + [c for c in pk if c not in keys]
    return (joined.withColumn(out, F.when(F.col("_rn") == 1, F.col("_prev")).otherwise(F.col("_lag")))
            .drop(*drop))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "step",
                segments: Segments | None = None) -> DataFrame:
    """1-based position of each row inside its key (a running count)."""
    return running_sums(df, keys, order, {out: F.lit(1).cast("bigint")}, segments=segments)


# ---- first occurrences ----------------------------------------------------

def first_flags(df: DataFrame, group: Sequence[str], order: Sequence, out: str = "is_first") -> DataFrame:
    """``out`` is true on the first row of each group in ``order``.

    The first row per group is a partial hash aggregate of one order value,
    joined back (no window over a whole group).
    """
    group = list(group)
    d = df.withColumn("_ord", order_value(df, order))
    firsts = d.groupBy(*group).agg(F.min("_ord").alias("_first"))
    return _join_on_keys(d, firsts, group).withColumn(out, F.col("_ord") == F.col("_first")).drop("_first", "_ord")


def repeat_flags(df: DataFrame, session: Sequence[str], value: str, order: Sequence,
                 out: str = "repeated") -> DataFrame:
    """Was this value already seen earlier in the session?"""
    flagged = first_flags(df, list(session) + [value], order, "_is_first")
    return flagged.withColumn(out, ~F.col("_is_first")).drop("_is_first")


def first_claims(df: DataFrame, slot: Sequence[str], order: Sequence, out: str = "accepted") -> DataFrame:
    """First writer of a slot wins; later claims of the slot are rejected."""
    return first_flags(df, slot, order, out)


def first_valid(df: DataFrame, key: Sequence[str], order: Sequence, valid: Column,
                out: str = "registered") -> DataFrame:
    """A key is registered by its first *valid* row; invalid rows (and rows
    whose validity is NULL) never take the key, later valid rows are
    duplicates.  Adds ``out`` and ``reason``."""
    d = df.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    d = d.withColumn("_ord", order_value(d, order))
    firsts = d.groupBy(*key).agg(F.min(F.when(F.col("_valid"), F.col("_ord"))).alias("_first"))
    joined = _join_on_keys(d, firsts, list(key))
    win = F.col("_valid") & (F.col("_ord") == F.col("_first"))
    return (joined.withColumn(out, win)
            .withColumn("reason", F.when(~F.col("_valid"), F.lit("not_numeric"))
                        .when(F.col(out), F.lit("ok")).otherwise(F.lit("duplicate")))
            .drop("_valid", "_ord", "_first"))


def turn_parity(df: DataFrame, game: Sequence[str], order: Sequence, accepted: str,
                players: Sequence[str] = ("X", "O"), out: str = "player",
                segments: Segments | None = None) -> DataFrame:
    """Whose turn a move is: parity of the number of *accepted* moves before
    it in the game (a rejected move does not pass the turn)."""
    counted = running_sums(df, game, order, {"_before": F.col(accepted).cast("bigint")},
                           exclusive=True, segments=segments)
    arr = F.array(*[F.lit(p) for p in players])
    idx = F.pmod(F.col("_before"), F.lit(len(players))).cast("int")
    return (counted.withColumn("accepted_before", F.col("_before"))
            .withColumn(out, F.get(arr, idx)).drop("_before"))


def claimed_turns(df: DataFrame, game: Sequence[str], slot: Sequence[str], order: Sequence,
                  players: Sequence[str] = ("X", "O"), accepted: str = "accepted", out: str = "player") -> DataFrame:
    """``first_claims`` of the slots of a game and ``turn_parity`` of its moves at once: ``accepted`` (the
    first claim of its slot), ``accepted_before`` and ``out``.

    For games of a bounded number of slots, such as the fields of a board, with any number of moves: a slot's first claim is
    a partial aggregate, a game's first claims are one short sorted array, and one
    join back tells each move how many of them come before it.  (Where
    slots are not bounded, use ``first_claims`` and ``turn_parity``.)
    """
    game, slot = list(game), list(slot)
    d = df.withColumn("_ord", order_value(df, order))
    firsts = d.groupBy(*game, *[c for c in slot if c not in game]).agg(F.min("_ord").alias("_first"))
    claims = firsts.groupBy(*game).agg(F.array_sort(F.collect_list("_first")).alias("_claims"))
    tagged = _join_on_keys(d, claims, game)
    before = F.size(F.filter("_claims", lambda c: c < F.col("_ord")))
    arr = F.array(*[F.lit(p) for p in players])
    return (tagged.withColumns({accepted: F.array_contains("_claims", F.col("_ord")), "accepted_before": before.cast("bigint")})
            .withColumn(out, F.get(arr, F.pmod("accepted_before", F.lit(len(players))).cast("int"))).drop("_ord", "_claims"))


# ---- sessions replayed as games -------------------------------------------

def running_counters(df: DataFrame, session: Sequence[str], value: str, order: Sequence,
                     targets: Sequence[str], segments: Segments | None = None) -> DataFrame:
    """Running counts per session: ``step`` (all rows), ``n_new`` (values not
    seen before), ``n_miss`` (new values outside ``targets``; a repeated miss
    is not counted again)."""
    flagged = first_flags(df, list(session) + [value], order, "is_new")
    miss = ~F.col(value).isin(list(targets))
    return running_sums(flagged, session, order, {
        "step": F.lit(1).cast("bigint"),
        "n_new": F.col("is_new").cast("bigint"),
        "n_miss": (F.col("is_new") & miss).cast("bigint"),
    }, segments=segments).withColumn("is_miss", miss)


def coverage_replay(df: DataFrame, session: Sequence[str], value: str, order: Sequence,
                    targets: Sequence[str], miss_budget: int) -> DataFrame:
    """Per session: the step at which every target value has been seen, the
    step at which the miss budget is used up, and the outcome (whichever
    comes first; ``unfinished`` if neither).  ``min_steps`` = number of targets.

    No running window: where each value first occurs is a partial aggregate, and two thresholds
    per session follow from it, the last of the targets' first occurrences and the
    ``miss_budget``-th of the others' (a limit per session, applied before the
    shuffle).  One join back counts the rows up to each threshold; its
    small side has one row a session, so AQE can split a hot one.
    """
    session, wanted = list(session), list(dict.fromkeys(targets))
    d = df.select(*session, F.col(value).alias("_v"), order_value(df, order).alias("_ord"))
    is_target = F.coalesce(F.col("_v").isin(wanted), F.lit(False))
    firsts = d.where(F.col("_v").isNotNull()).groupBy(*session, "_v").agg(F.min("_ord").alias("_first")).withColumn("_target", is_target)
    # targets first, so that a session's first rows hold them all and enough of the others
    along = Window.partitionBy(*session).orderBy(~F.col("_target"), "_first")
    few = firsts.withColumn("_rn", F.row_number().over(along)).where(F.col("_rn") <= len(wanted) + max(miss_budget, 0))
    seen = F.sum(F.col("_target").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    few = few.withColumn("_seen", seen)
    limits = few.groupBy(*session).agg(
        F.max(F.when(F.col("_target") & (F.col("_seen") == len(wanted)), F.col("_first"))).alias("_covered"),
        F.max(F.when(~F.col("_target") & (F.col("_rn") - F.col("_seen") == miss_budget), F.col("_first"))).alias("_spent"))
    per = _join_on_keys(d, limits, session, "left").groupBy(*session).agg(
        F.count("*").alias("n_steps"), F.count_if(F.col("_ord") <= F.col("_covered")).alias("_c"),
        F.count_if(F.col("_ord") <= F.col("_spent")).alias("_b"))
    # a threshold is itself a row of the session, so a count of none means that there is no threshold
    covered, budget = (F.when(F.col(c) > 0, F.col(c)) for c in ("_c", "_b"))
    per = per.withColumns({"covered_step": covered, "budget_step": budget})
    outcome = (F.when(F.col("covered_step").isNotNull()
                      & (F.col("budget_step").isNull() | (F.col("covered_step") < F.col("budget_step"))),
                      F.lit("covered"))
               .when(F.col("budget_step").isNotNull(), F.lit("exhausted"))
               .otherwise(F.lit("unfinished")))
    steps_used = F.coalesce(F.least(F.col("covered_step"), F.col("budget_step")), F.col("n_steps"))
    return per.select(*session, "covered_step", "budget_step", outcome.alias("outcome"),
                      steps_used.cast("bigint").alias("steps_used"),
                      F.lit(len(wanted)).cast("bigint").alias("min_steps"))


# ---- ends and global order ------------------------------------------------

def first_last(df: DataFrame, keys: Sequence[str], order: Sequence, value: str,
               first: str = "first_value", last: str = "last_value") -> DataFrame:
    """First and last ``value`` per key in ``order``.

    The two order values per key are one partial hash aggregate; the values
    are read from the rows that have them (two rows a key)."""
    keys = list(keys)
    d = df.select(*keys, F.col(value).alias("_v"), order_value(df, order).alias("_ord"))
    ends = d.groupBy(*keys).agg(F.min("_ord").alias("_lo"), F.max("_ord").alias("_hi"))
    marked = _join_on_keys(d, ends, keys).where((F.col("_ord") == F.col("_lo")) | (F.col("_ord") == F.col("_hi")))
    pair = F.array_sort(F.collect_list(F.struct("_ord", "_v")))
    return marked.groupBy(*keys).agg(pair.alias("_p")).select(
        *keys, F.get("_p", F.lit(0))["_v"].alias(first), F.element_at("_p", F.lit(-1))["_v"].alias(last))


def global_ordinal(df: DataFrame, order: Sequence, out: str = "rank",
                   partitions: int | None = None) -> DataFrame:
    """1-based position of each row in a total ``order`` over the whole table.

    Never a single-partition window: rows are range-partitioned and sorted
    inside each partition, and ``monotonically_increasing_id`` numbers them
    inside their partition.  That frame is checkpointed once to the
    session's checkpoint folder (range bounds come from a sample, which
    differs between two evaluations of an input whose row order is not
    fixed, so both uses must read the same materialised partitions; this
    also cuts the lineage).  A partition's offset is the number of rows in
    the partitions before it: one row per partition, broadcast.
    ``order`` must be a total order (end with a unique column).
    """
    from tessera.session import require_checkpoint_dir

    require_checkpoint_dir(df.sparkSession)
    ordc = _order_cols(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *ordc).sortWithinPartitions(*ordc)
              .withColumn("_rid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    ranged = ranged.withColumn("_part", F.shiftright(F.col("_rid"), 33))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_rid").alias("_first"))
    # one row per partition: a window without keys over it is tiny
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = ranged.join(F.broadcast(offsets), "_part")
    rank = (F.col("_off") + F.col("_rid") - F.col("_first") + 1).cast("bigint")
    return joined.withColumn(out, rank).drop("_rid", "_part", "_first", "_off")

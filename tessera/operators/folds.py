"""Ordered folds: a capped additive score, paired settlement and a guarded
account ledger.

* ``hand_values`` is a closed form over per-hand aggregates (sum, count of
  flexible cards), so it is one partial aggregate.
* ``ledger`` is a fold whose decisions feed back (a rejected withdrawal
  changes every later decision), so it has no window or associative form.
  Rows are hash-partitioned by account and sorted inside each partition;
  ``mapInArrow`` then walks each partition in batches, carrying the open
  account's balance across batch boundaries.  Memory per task is one batch,
  whatever the size of an account, and no group is collected.  All accounts of
  a batch are tried at once with a prefix sum that assumes every withdrawal is
  accepted; only accounts where one is not are walked event by event, from
  there on.
* An account with many events is cut into chunks at row ranks.  A chunk's
  summary (net sum, least prefix sum at a withdrawal) closes it in one step
  where its opening balance covers the least prefix: nothing in it is
  rejected, whatever the balance is otherwise.  Only the first chunk of an account that is not covered is
  walked to know the balance after it, then the summaries go on from there.
  Once every chunk's opening balance is known, all chunks are folded side by side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.windows import Segments, _join_on_keys, _with_chunk
from tessera.session import stored
from tessera.sources.literals import literal_map

# ---- capped additive score ------------------------------------------------

def hand_values(cards: DataFrame, hand: Sequence[str], card_value: Column, is_flexible: Column,
                cap: int = 21, flex_drop: int = 10) -> DataFrame:
    """Score per hand: sum of card values; while the sum is over ``cap`` and
    a flexible card (worth ``flex_drop`` less on demand) remains, take
    ``flex_drop`` off.  Closed form of that loop:
    ``raw - flex_drop * least(flex, greatest(0, ceil((raw - cap) / flex_drop)))``.
    """
    agg = cards.groupBy(*hand).agg(
        F.count("*").alias("n_cards"),
        F.sum(card_value).cast("bigint").alias("raw_value"),
        F.count_if(is_flexible).cast("bigint").alias("n_flexible"),
    )
    over = F.greatest(F.lit(0), F.ceil((F.col("raw_value") - cap) / F.lit(flex_drop)))
    drops = F.least(F.col("n_flexible"), over)
    return agg.withColumn("hand_value", (F.col("raw_value") - flex_drop * drops).cast("bigint"))


def rank_value(rank: Column, values: Mapping[str, int]) -> Column:
    """Card value from its rank through a literal map (no join)."""
    return F.element_at(literal_map(values), rank)


def settle(player_value, dealer_value, bet, cap: int = 21) -> Column:
    """Signed amount for the player: exactly ``cap`` wins, over ``cap``
    loses, dealer over ``cap`` wins, higher wins, a tie loses."""
    p = F.col(player_value) if isinstance(player_value, str) else player_value
    d = F.col(dealer_value) if isinstance(dealer_value, str) else dealer_value
    b = F.col(bet) if isinstance(bet, str) else bet
    win = (F.when(p == cap, True).when(p > cap, False).when(d > cap, True)
           .when(p > d, True).otherwise(False))
    return F.when(win, b).otherwise(-b)


def settle_outcome(player_value, dealer_value, cap: int = 21) -> Column:
    p = F.col(player_value) if isinstance(player_value, str) else player_value
    d = F.col(dealer_value) if isinstance(dealer_value, str) else dealer_value
    return (F.when(p == cap, "win_exact").when(p > cap, "lose_bust").when(d > cap, "win_dealer_bust")
            .when(p > d, "win_higher").otherwise("lose"))


# ---- guarded ledger -------------------------------------------------------

TOTALS = ("balance", "n_deposits", "n_withdrawals", "n_rejected", "rejected_amount")
REASONS = ("ok", "no_amount", "negative", "insufficient")


def walk_batch(starts: np.ndarray, amount: np.ndarray, is_w: np.ndarray, valid: np.ndarray,
               opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(accepted, balance_after)`` of the events of several accounts.

    Account ``k`` has the rows from ``starts[k]`` on and opens with ``opening[k]``.
    """
    n = len(amount)
    lengths = np.diff(np.append(starts, n))
    signed = np.where(valid, np.where(is_w, -amount, amount), 0)
    total = np.cumsum(signed)
    after = total + np.repeat(opening - (total[starts] - signed[starts]), lengths)
    accepted = valid & ~(is_w & (amount > after - signed))
    run = np.repeat(np.arange(len(starts)), lengths)
    stopped = np.flatnonzero(valid & ~accepted)
    if len(stopped) == 0:
        return accepted, after
    walked, first = np.unique(run[stopped], return_index=True)
    for k, at in zip(walked.tolist(), stopped[first].tolist(), strict=True):
        end = int(starts[k] + lengths[k])
        balance = int(after[at] - signed[at])
        yes, balances = [], []
        for x, w, ok in zip(amount[at:end].tolist(), is_w[at:end].tolist(), valid[at:end].tolist(), strict=True):
            ok = ok and not (w and x > balance)
            if ok:
                balance += -x if w else x
            yes.append(ok)
            balances.append(balance)
        accepted[at:end], after[at:end] = yes, balances
    return accepted, after


def ledger(events: DataFrame, account: str, order: Sequence[str], kind: str, amount: Column,
           deposit_kinds: Sequence[str], withdraw_kinds: Sequence[str], event_id: str | None = None,
           per_event: bool = False, partitions: int | None = None, opening: str | None = None,
           chunk_rows: int | None = None, walks: int = 8) -> DataFrame:
    """Guarded balance per account, in ``order``: a deposit is always accepted,
    a withdrawal only if it does not exceed the balance; a rejected
    withdrawal leaves the balance unchanged.  Negative and NULL amounts are
    rejected (a NULL adds nothing to ``rejected_amount``).  Events without an
    account belong to one account of their own, the NULL account.

    Returns per account ``balance, n_deposits, n_withdrawals, n_rejected,
    rejected_amount`` or, with ``per_event``, each event with ``accepted``,
    ``balance_after`` and ``reason``.  ``amount`` must be integral (cents).
    ``opening`` names a column with the account's balance before its first
    event here (the same on all its rows; NULL is 0).

    With ``chunk_rows``, accounts of more events are spread over tasks in chunks
    of about that many (see the module); this starts jobs at once.  An account
    that still has uncovered chunks after ``walks`` turns is folded from there on by one task.
    """
    kinds = list(deposit_kinds) + list(withdraw_kinds)
    eid = F.col(event_id).cast("bigint") if event_id else F.lit(None).cast("bigint")
    start = F.coalesce(F.col(opening).cast("bigint"), F.lit(0)) if opening else F.lit(0).cast("bigint")
    ordered = [c for c in order if c != account]
    ev = (events.where(F.col(kind).isin(kinds))
          .select(F.col(account), *[F.col(c) for c in ordered],
                  F.col(kind).isin(list(withdraw_kinds)).alias("_w"),
                  amount.cast("bigint").alias("_amt"), eid.alias("_eid"), start.alias("_open")))
    if chunk_rows is None:
        return _folded(ev.withColumn("_group", F.lit(0).cast("bigint")), account, order, per_event, partitions, [account]).drop("_group")
    cut = _with_chunk(ev, [account], list(order), Segments(chunk_rows=chunk_rows), is_cut="_many").withColumnRenamed("_chunk", "_group")
    large = stored(cut.where("_many").drop("_many"), "ledger-large")
    rest = cut.where(~F.col("_many")).drop("_many")
    if large.limit(1).count():
        opened = _opened_chunks(large, account, order, partitions, walks)
        joined = _join_on_keys(large.drop("_open"), opened, [account, "_group"])
        rest = rest.unionByName(joined.drop("_group").withColumnRenamed("_to", "_group"))
    out = _folded(rest, account, order, per_event, partitions, [account, "_group"])
    if per_event:
        return out.drop("_group")
    # the chunks of an account: the last one has its balance
    return out.groupBy(account).agg(F.max_by("balance", "_group").alias("balance"), *[F.sum(c).alias(c) for c in TOTALS[1:]])


def _opened_chunks(rows: DataFrame, account: str, order: Sequence[str], partitions: int | None, walks: int) -> DataFrame:
    """``account, _group, _to, _open`` for every chunk ``_group`` of ``rows``: the group
    it is folded in, and that group's opening balance.

    One row per chunk is kept; turns look at the chunks from each account's
    first undecided one on.  A running sum over their nets gives the opening balances as long
    as every chunk before is covered; the first uncovered chunk of each account
    is walked, all accounts side by side.
    """
    good = F.coalesce(F.col("_amt") >= 0, F.lit(False))
    signed = F.when(good, F.when(F.col("_w"), -F.col("_amt")).otherwise(F.col("_amt"))).otherwise(0)
    inside = Window.partitionBy(account, "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    chunks = stored(
        rows.withColumns({"_s": signed, "_run": F.sum(signed).over(inside)}).groupBy(account, "_group").agg(
            F.sum("_s").alias("_net"), F.min(F.when(F.col("_w") & good, F.col("_run"))).alias("_least"), F.max("_open").alias("_open")),
        "ledger-chunks")
    front = chunks.groupBy(account).agg(F.min("_group").alias("_next"), F.max("_open").alias("_balance"))
    along = Window.partitionBy(account).orderBy("_group")
    done = []
    for turn in range(walks + 1):
        ahead = _join_on_keys(chunks.drop("_open"), front, [account]).where(F.col("_group") >= F.col("_next"))
        ahead = ahead.withColumn("_open", F.col("_balance") + F.sum("_net").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_net"))
        ahead = ahead.withColumn("_short", F.coalesce(F.col("_open") + F.col("_least") < 0, F.lit(False)))
        first = F.min(F.when(F.col("_short"), F.col("_group"))).over(Window.partitionBy(account))
        state = stored(ahead.select(account, "_group", "_open", first.alias("_first")), "ledger-turn")
        sure = state.where("_first is null or _group <= _first")
        done.append(sure.select(account, "_group", F.col("_group").alias("_to"), "_open"))
        stop = state.where("_group = _first").select(account, "_group", "_open")
        if not stop.limit(1).count():
            break
        if turn == walks:  # one group from the uncovered chunk on
            later = state.where("_group > _first").select(account, "_group", F.col("_first").alias("_to"))
            done.append(_join_on_keys(later, stop.withColumnRenamed("_group", "_first"), [account]).select(account, "_group", "_to", "_open"))
            break
        walked = _join_on_keys(rows.drop("_open"), stop, [account, "_group"])
        closed = _folded(walked, account, order, False, partitions, [account])
        front = stored(closed.select(account, (F.col("_group") + 1).alias("_next"), F.col("balance").alias("_balance")), "ledger-front")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _folded(ev: DataFrame, account: str, order: Sequence[str], per_event: bool, partitions: int | None, dealt: list[str]) -> DataFrame:
    """The fold of each (account, ``_group``), opened with ``_open``; ``dealt`` says by what rows are shuffled."""
    n = partitions or int(ev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ev = ev.repartition(n, *dealt).sortWithinPartitions(account, "_group", *order)
    ev = ev.select(account, "_w", "_amt", "_eid", "_open", "_group")
    names = [account, "_group", *TOTALS]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the group open at the end of a batch: its key, its value and totals
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, group = batch.column(0), batch.column(5)
            code, number = key.dictionary_encode().indices.fill_null(-1).to_numpy(), group.to_numpy()
            amt = batch.column(2)
            valid = pc.fill_null(pc.greater_equal(amt, 0), False).to_numpy(zero_copy_only=False)
            value = amt.fill_null(0).to_numpy()
            is_w = batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (number[1:] != number[:-1])))
            begin = batch.column(4).to_numpy()[starts].copy()
            goes_on = held is not None and (key[0].as_py(), int(number[0])) == held[0]
            if goes_on:
                begin[0] = held[1][0]
            accepted, after = walk_batch(starts, value, is_w, valid, begin)
            if per_event:
                reason = np.where(accepted, 0, np.where(valid, 3, 2))
                reason[amt.is_null().to_numpy(zero_copy_only=False)] = 1
                yield pa.RecordBatch.from_arrays(
                    [key, group, batch.column(3), pa.array(accepted), pa.array(after), pa.array(REASONS).take(pa.array(reason))],
                    names=[account, "_group", "event_id", "accepted", "balance_after", "reason"])
            ends = np.append(starts[1:], len(code)) - 1
            sums = [np.add.reduceat(x.astype(np.int64), starts) for x in (
                accepted & ~is_w, accepted & is_w, ~accepted, np.where(accepted, 0, np.abs(value)))]
            if goes_on:
                for total, before in zip(sums, held[1][1:], strict=True):
                    total[0] += before
            elif held is not None and not per_event:
                yield finished(pa.array([held[0][0]], key.type), [held[0][1]], [np.array([x]) for x in held[1]])
            held = ((key[int(starts[-1])].as_py(), int(number[-1])), [int(after[-1]), *[int(x[-1]) for x in sums]])
            if len(starts) > 1 and not per_event:
                yield finished(key.take(pa.array(starts[:-1])), number[starts[:-1]], [after[ends[:-1]], *[x[:-1] for x in sums]])
            kind_of_key = key.type
        if held is not None and not per_event:
            yield finished(pa.array([held[0][0]], kind_of_key), [held[0][1]], [np.array([x]) for x in held[1]])

    def finished(key: pa.Array, group: Sequence[int], totals: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([key, pa.array(group, pa.int64()), *[pa.array(x, pa.int64()) for x in totals]], names=names)

    long = T.LongType()
    first = [T.StructField(account, ev.schema[account].dataType), T.StructField("_group", long)]
    if per_event:
        fields = [T.StructField("event_id", long), T.StructField("accepted", T.BooleanType()),
                  T.StructField("balance_after", long), T.StructField("reason", T.StringType())]
    else:
        fields = [T.StructField(c, long) for c in TOTALS]
    return ev.mapInArrow(fold, T.StructType([*first, *fields]))


# Functions of this module run inside Python workers (mapInArrow).  They are
# pickled by value, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

import itertools
import math
import random

import pandas as pd
import pytest
from conftest import SF01, rows
from pyspark.sql import functions as F

from tessera.operators import folds, windows
from tessera.sources import cards


def _loop_value(hand):
    """The reference's add-then-adjust loop."""
    value, aces = 0, 0
    for rank in hand:
        value += cards.VALUES[rank]
        aces += rank == "Ace"
        while value > 21 and aces:
            value -= 10
            aces -= 1
    return value


def _closed_form(hand):
    raw = sum(cards.VALUES[r] for r in hand)
    aces = sum(r == "Ace" for r in hand)
    return raw - 10 * min(aces, max(0, math.ceil((raw - 21) / 10)))


def test_closed_form_equals_loop_for_all_small_hands():
    ranks = list(cards.RANKS)
    n = 0
    for size in range(1, 5):
        for hand in itertools.product(ranks, repeat=size):
            assert _closed_form(hand) == _loop_value(hand), hand
            n += 1
    assert n == 13 + 13 ** 2 + 13 ** 3 + 13 ** 4


def test_hand_values(spark):
    hands = [["Ace", "King"], ["Ace", "Ace"], ["Ace", "Ace", "Nine"], ["Ten", "Nine", "Five"], ["Ace", "Five", "Ten"]]
    df = spark.createDataFrame([(h, i, r) for h, hand in enumerate(hands) for i, r in enumerate(hand)],
                               "hand_id long, seq int, rank string")
    out = folds.hand_values(df, ["hand_id"], folds.rank_value(F.col("rank"), cards.VALUES), F.col("rank") == "Ace")
    assert [v for _, v in rows(out, "hand_id", "hand_value")] == [21, 12, 21, 24, 16]


def test_settle(spark):
    pairs = [(21, 18), (24, 18), (20, 22), (20, 18), (19, 19), (17, 20)]
    df = spark.createDataFrame([(i, p, d, 10) for i, (p, d) in enumerate(pairs)], "g int, p int, d int, bet long")
    got = [r[0] for r in df.orderBy("g").select(folds.settle("p", "d", "bet")).collect()]
    assert got == [10, -10, 10, 10, -10, -10]


def _py_ledger(events):
    """Reference rules: deposit always, withdrawal only if amount <= balance."""
    out = {}
    for acct, _, is_w, amt in sorted(events, key=lambda e: (e[0], e[1])):
        bal, dep, wd, rej, rej_amt = out.get(acct, (0, 0, 0, 0, 0))
        if amt < 0 or (is_w and amt > bal):
            rej, rej_amt = rej + 1, rej_amt + abs(amt)
        elif is_w:
            bal, wd = bal - amt, wd + 1
        else:
            bal, dep = bal + amt, dep + 1
        out[acct] = (bal, dep, wd, rej, rej_amt)
    return sorted((k, *v) for k, v in out.items())


def _ledger_df(spark, events):
    pdf = pd.DataFrame(events, columns=["acct", "seq", "is_w", "amount"])
    pdf["kind"] = pdf["is_w"].map({True: "withdraw", False: "deposit"})
    return spark.createDataFrame(pdf[["acct", "seq", "kind", "amount"]])


def test_ledger_account_example(spark):
    events = [("Jose", 1, False, 100), ("Jose", 2, False, 50), ("Jose", 3, True, 50), ("Jose", 4, True, 200)]
    df = _ledger_df(spark, events)
    out = folds.ledger(df, "acct", ["seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"])
    assert rows(out) == [("Jose", 100, 2, 1, 1, 200)]
    per = folds.ledger(df, "acct", ["seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"],
                       event_id="seq", per_event=True)
    assert rows(per, "event_id", "accepted", "balance_after") == [(1, True, 100), (2, True, 150), (3, True, 100),
                                                                  (4, False, 100)]


def test_ledger_random_against_loop_small_batches(spark):
    rnd = random.Random(5)
    events = []
    for i in range(6000):
        acct = "hot" if i % 3 == 0 else f"a{rnd.randrange(40)}"
        events.append((acct, i, rnd.random() < 0.55, rnd.randrange(-2, 300)))
    df = _ledger_df(spark, events)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        out = folds.ledger(df, "acct", ["seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"], partitions=3)
        got = rows(out)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _py_ledger(events)


def _hot(n, seed, withdraw_share, hot="hot"):
    """Events of one account with half of all rows, of small ones and of the NULL account; ties in time, missing and negative amounts."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        acct = hot if i % 2 == 0 else None if i % 5 == 0 else f"a{rnd.randrange(30)}"
        amount = None if rnd.random() < 0.01 else rnd.randrange(-3, 100)
        out.append((acct, i // 50, i, rnd.random() < withdraw_share, amount))
    return out


def _loop(events, opening=0):
    totals, each = {}, {}
    for acct, _, i, is_w, amt in sorted(events, key=lambda e: e[1:3]):
        bal, dep, wd, rej, rej_amt = totals.get(acct, (opening, 0, 0, 0, 0))
        reason = "no_amount" if amt is None else "negative" if amt < 0 else "insufficient" if is_w and amt > bal else "ok"
        if reason == "ok":
            bal, dep, wd = bal + (-amt if is_w else amt), dep + (not is_w), wd + is_w
        else:
            rej, rej_amt = rej + 1, rej_amt + abs(amt or 0)
        totals[acct], each[i] = (bal, dep, wd, rej, rej_amt), (reason == "ok", bal, reason)
    return totals, each


# few rejections; one early chunk short of money; rejections in every chunk (one task goes on from the last walk)
@pytest.mark.parametrize("share,walks,opening", [(0.45, 8, 0), (0.45, 8, 700), (0.7, 2, 0), (0.7, 0, 0), (0.5, 40, 0)])
def test_ledger_of_a_hot_account_in_chunks(spark, share, walks, opening):
    events = _hot(6000, 11, share)
    df = spark.createDataFrame([(a, t, i, "withdraw" if w else "deposit", x, opening) for a, t, i, w, x in events],
                               "acct string, t int, seq long, kind string, amount long, opening long").repartition(5)
    args = (df, "acct", ["t", "seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"])
    options = {"chunk_rows": 150, "walks": walks, "opening": "opening"}
    totals, each = _loop(events, opening)
    got = folds.ledger(*args, **options)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == totals
    per = folds.ledger(*args, event_id="seq", per_event=True, **options)
    assert {r["event_id"]: (r["accepted"], r["balance_after"], r["reason"]) for r in per.collect()} == each
    assert got.columns == ["acct", *folds.TOTALS]


def test_chunks_of_a_hot_account_are_folded_side_by_side(spark):
    """Where little is rejected nearly every chunk is a group of its own, and few are walked."""
    events = _hot(6000, 3, 0.4)
    rows = spark.createDataFrame([(a, t, i, w, x, i, 0) for a, t, i, w, x in events if a == "hot"],
                                 "acct string, t int, seq long, _w boolean, _amt long, _eid long, _open long")
    cut = windows._with_chunk(rows, ["acct"], ["t", "seq"], windows.Segments(chunk_rows=150)).withColumnRenamed("_chunk", "_group")
    opened = folds._opened_chunks(cut, "acct", ["t", "seq"], None, 8).collect()
    assert len(opened) >= 12 and all(r["_group"] == r["_to"] for r in opened)
    starts = {r["_group"]: r["_open"] for r in opened}
    first = {}
    for r in cut.orderBy("t", "seq").collect():
        first.setdefault(r["_group"], r["seq"])
    _, each = _loop([e for e in events if e[0] == "hot"])
    before = 0
    for i in sorted(each):
        for g, seq in first.items():
            if seq == i:
                assert starts[g] == before
        before = each[i][1]


def test_ledger_in_chunks_without_large_accounts(spark):
    events = _hot(300, 4, 0.5, hot=None)
    df = spark.createDataFrame([(a, t, i, "withdraw" if w else "deposit", x) for a, t, i, w, x in events],
                               "acct string, t int, seq long, kind string, amount long")
    out = folds.ledger(df, "acct", ["t", "seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"], chunk_rows=10_000)
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == _loop(events)[0]
    none = folds.ledger(df.limit(0), "acct", ["t", "seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"], chunk_rows=100)
    assert none.collect() == []


def test_ledger_empty_input(spark):
    df = spark.createDataFrame([], "acct string, seq long, kind string, amount long")
    out = folds.ledger(df, "acct", ["seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"])
    assert out.count() == 0


def test_ledger_on_events_matches_loop(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    out = folds.ledger(e, "user_id", ["ts", "event_id"], "event_type", F.round(F.col("value") * 100),
                       ["signup"], ["purchase"])
    local = [(r["user_id"], (r["ts"], r["event_id"]), r["event_type"] == "purchase", int(round(r["value"] * 100)))
             for r in e.where(F.col("event_type").isin("signup", "purchase")).collect()]
    got = rows(out)
    assert got == _py_ledger(local)
    assert sum(r[1] for r in got) > 0

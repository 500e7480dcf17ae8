import random

import pytest
from conftest import SF01, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import windows
from tessera.operators.windows import Segments


def _skewed(spark):
    """Events where key 0 holds a third of all rows, spread over many chunks."""
    n = 30000
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        (F.col("id") * 7 % 1000).alias("t"),
        (F.col("id") % 11 - 3).alias("v"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("s"),
    )


def test_segmented_running_sum_equals_window(spark):
    df = _skewed(spark)
    order = ["t", "event_id"]
    plain = windows.running_sums(df, ["k"], order, {"rs": F.col("v"), "cnt": F.lit(1)})
    seg = windows.running_sums(df, ["k"], order, {"rs": F.col("v"), "cnt": F.lit(1)},
                               segments=Segments(chunk=F.floor(F.col("t") / 50)))
    assert rows(plain, "event_id", "rs", "cnt") == rows(seg, "event_id", "rs", "cnt")
    excl = windows.running_sums(df, ["k"], order, {"rs": F.col("v")}, segments=Segments(chunk=F.floor(F.col("t") / 50)), exclusive=True)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("rs", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert rows(excl, "event_id", "rs") == rows(ref, "event_id", "rs")


def test_hot_key_only_segmentation(spark):
    # key 0 (10,000 rows) is above the threshold, the other keys (~200 rows) are not
    df = _skewed(spark)
    order = ["t", "event_id"]
    plain = windows.running_sums(df, ["k"], order, {"rs": F.col("v")})
    hot = windows.running_sums(df, ["k"], order, {"rs": F.col("v")}, segments=Segments(chunk_rows=700))
    assert rows(plain, "event_id", "rs") == rows(hot, "event_id", "rs")
    lag_hot = windows.previous_value(df, ["k"], order, "s", "prev", segments=Segments(chunk_rows=700))
    ref = df.withColumn("prev", F.lag("s").over(Window.partitionBy("k").orderBy(*order)))
    assert rows(lag_hot, "event_id", "prev") == rows(ref, "event_id", "prev")


def test_segmented_lag_equals_lag(spark):
    df = _skewed(spark)
    order = ["t", "event_id"]
    seg = windows.previous_value(df, ["k"], order, "s", "prev", segments=Segments(chunk=F.floor(F.col("t") / 37)))
    ref = df.withColumn("prev", F.lag("s").over(Window.partitionBy("k").orderBy(*order)))
    assert rows(seg, "event_id", "prev") == rows(ref, "event_id", "prev")


def test_segmented_plan_spreads_hot_key(spark):
    df = _skewed(spark)
    seg = windows.running_sums(df, ["k"], ["t", "event_id"], {"rs": F.col("v")}, segments=Segments(chunk=F.floor(F.col("t") / 50)))
    plan = seg._jdf.queryExecution().executedPlan().toString()
    # the row-level window is partitioned by key *and* chunk
    assert "_chunk" in plan and "Window" in plan


def test_first_flags_and_repeats(spark):
    df = spark.createDataFrame([(1, 1, "E"), (1, 2, "X"), (1, 3, "X"), (1, 4, "V"), (1, 5, "A"), (2, 1, "X")],
                               "session long, step long, letter string")
    out = windows.repeat_flags(df, ["session"], "letter", ["step"])
    assert rows(out, "session", "step", "repeated") == [(1, 1, False), (1, 2, False), (1, 3, True), (1, 4, False),
                                                        (1, 5, False), (2, 1, False)]


def test_guess_session_replay(spark):
    # target word EVA; guesses e, x, x, v, a
    df = spark.createDataFrame([(1, i + 1, g) for i, g in enumerate("EXXVA")], "session long, step long, letter string")
    c = windows.running_counters(df, ["session"], "letter", ["step"], ["E", "V", "A"])
    last = c.orderBy(F.desc("step")).first()
    assert (last["step"], last["n_new"], last["n_miss"]) == (5, 4, 1)
    r = windows.coverage_replay(df, ["session"], "letter", ["step"], ["E", "V", "A"], miss_budget=6).first()
    assert (r["covered_step"], r["budget_step"], r["outcome"], r["steps_used"], r["min_steps"]) == (5, None, "covered", 5, 3)
    r2 = windows.coverage_replay(df, ["session"], "letter", ["step"], ["E", "V", "A", "Z"], miss_budget=1).first()
    assert (r2["outcome"], r2["budget_step"]) == ("exhausted", 2)


def test_first_claim_and_turn_parity(spark):
    # (1,1) by player 1, (1,1) again rejected, (2,2) next: the rejected move does not pass the turn
    df = spark.createDataFrame([(1, 1, "1,1"), (1, 2, "1,1"), (1, 3, "2,2")], "game long, seq long, cell string")
    claimed = windows.first_claims(df, ["game", "cell"], ["seq"])
    out = windows.turn_parity(claimed, ["game"], ["seq"], "accepted", players=("1", "2"))
    assert rows(out, "seq", "accepted", "player") == [(1, True, "1"), (2, False, "2"), (3, True, "2")]


def test_first_valid_registration(spark):
    df = spark.createDataFrame([(1, "a", "300"), (2, "b", "x"), (3, "a", "200"), (4, "b", "250")],
                               "seq long, kind string, kcal string")
    from tessera.functions.numbers import parse_int
    out = windows.first_valid(df, ["kind"], ["seq"], parse_int(F.col("kcal")).isNotNull())
    assert rows(out, "seq", "registered", "reason") == [(1, True, "ok"), (2, False, "not_numeric"),
                                                        (3, False, "duplicate"), (4, True, "ok")]


def test_first_last(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1, 2, 3, 4, 5, 6])], "k long, pos long, v long")
    assert rows(windows.first_last(df, ["k"], ["pos"], "v")) == [(1, 1, 6)]


def test_global_ordinal_is_exact(spark):
    p = spark.read.parquet(f"{SF01}/part.parquet").select("p_partkey", "p_retailprice")
    got = windows.global_ordinal(p, ["p_retailprice", "p_partkey"], partitions=5)
    ref = sorted(p.collect(), key=lambda r: (r["p_retailprice"], r["p_partkey"]))
    expected = [(r["p_partkey"], i + 1) for i, r in enumerate(ref)]
    assert rows(got, "p_partkey", "rank") == sorted(expected)


def test_row_numbers_segmented(spark):
    df = _skewed(spark)
    seg = windows.row_numbers(df, ["k"], ["t", "event_id"], segments=Segments(chunk=F.floor(F.col("t") / 100)))
    ref = df.withColumn("step", F.row_number().over(Window.partitionBy("k").orderBy("t", "event_id")))
    assert rows(seg, "event_id", "step") == rows(ref, "event_id", "step")


def test_segmented_scan_keeps_null_keys(spark):
    df = _skewed(spark).withColumn("k", F.when(F.col("k") == 5, F.lit(None)).otherwise(F.col("k")))
    order = ["t", "event_id"]
    plain = windows.running_sums(df, ["k"], order, {"rs": F.col("v")})
    seg = windows.running_sums(df, ["k"], order, {"rs": F.col("v")}, segments=Segments(chunk=F.floor(F.col("t") / 50)))
    assert seg.count() == df.count()
    assert rows(plain, "event_id", "rs") == rows(seg, "event_id", "rs")
    lag = windows.previous_value(df, ["k"], order, "s", "prev", segments=Segments(chunk=F.floor(F.col("t") / 50)))
    ref = df.withColumn("prev", F.lag("s").over(Window.partitionBy("k").orderBy(*order)))
    assert rows(lag, "event_id", "prev") == rows(ref, "event_id", "prev")


def test_global_ordinal_over_shuffled_input(spark):
    # an aggregated input has no fixed row order; ranks must still be exact
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 5003).alias("k")).groupBy("k").agg(
        F.count("*").alias("n"))
    got = windows.global_ordinal(df, ["n", "k"], partitions=7)
    ref = sorted((r["n"], r["k"]) for r in df.collect())
    expected = sorted((k, i + 1) for i, (n, k) in enumerate(ref))
    assert rows(got, "k", "rank") == expected


def test_chunks_follow_row_ranks_equal_window(spark):
    df = _skewed(spark)
    order = ["t", "event_id"]
    seg = Segments(chunk_rows=700)
    got = windows.running_sums(df, ["k"], order, {"rs": F.col("v")}, segments=seg)
    ref = windows.running_sums(df, ["k"], order, {"rs": F.col("v")})
    assert rows(got, "event_id", "rs") == rows(ref, "event_id", "rs")
    lag = windows.previous_value(df, ["k"], order, "s", "prev", segments=seg)
    ref_lag = df.withColumn("prev", F.lag("s").over(Window.partitionBy("k").orderBy(*order)))
    assert rows(lag, "event_id", "prev") == rows(ref_lag, "event_id", "prev")


def test_bunched_hot_keys_are_cut(spark):
    # key 0: 20,000 rows at one timestamp; key 1: one row in 2020, 19,999 in 2024
    one = F.lit("2024-03-01 12:00:00").cast("timestamp_ntz")
    old = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    df = spark.range(40000).select(
        F.col("id"), (F.col("id") % 2).alias("k"), (F.col("id") % 13).alias("v"),
        F.when((F.col("id") == 1), old).otherwise(one).alias("ts"))
    seg = Segments(chunk_rows=500)
    sizes = [r["count"] for r in windows._with_chunk(df, ["k"], ["ts", "id"], seg).groupBy("k", "_chunk").count().collect()]
    assert max(sizes) < 1500 and 50 <= len(sizes) <= 130
    got = windows.running_sums(df, ["k"], ["ts", "id"], {"rs": F.col("v")}, segments=seg)
    ref = windows.running_sums(df, ["k"], ["ts", "id"], {"rs": F.col("v")})
    assert rows(got, "id", "rs") == rows(ref, "id", "rs")


def test_order_values_sort_like_their_columns(spark):
    from tessera.operators.ordering import order_value, unpacked
    df = spark.sql("""select * from values (timestamp_ntz'2024-01-01 10:00:00.000001', -5L), (timestamp_ntz'2024-01-01 10:00:00.000001', 9223372036854775807L),
      (timestamp_ntz'1960-12-31 23:59:59.999999', -9223372036854775808L), (null, 3L), (timestamp_ntz'2024-01-01 10:00:00', null), (null, null) as t(ts, id)""")
    by_value = [tuple(r) for r in df.withColumn("o", order_value(df, ["ts", "id"])).orderBy("o").select("ts", "id").collect()]
    assert by_value == [tuple(r) for r in df.orderBy("ts", "id").collect()]
    pairs = [(0, 0), (2**61, -2**63), (-2**61, 2**63 - 1), (7, -1)]
    ints = spark.createDataFrame(pairs, "a long, b long")
    assert [tuple(r) for r in ints.select(*unpacked(order_value(ints, ["a", "b"]))).collect()] == pairs


def test_segments_keep_rows_with_null_order_values(spark):
    df = _skewed(spark).withColumn("t", F.when(F.col("event_id") % 101 == 0, F.lit(None)).otherwise(F.col("t")))
    order = ["t", "event_id"]
    ref = windows.running_sums(df, ["k"], order, {"rs": F.col("v")})
    for seg in (Segments(chunk=F.floor(F.col("t") / 50)), Segments(chunk_rows=700)):
        got = windows.running_sums(df, ["k"], order, {"rs": F.col("v")}, segments=seg)
        assert got.count() == df.count()
        assert rows(got, "event_id", "rs") == rows(ref, "event_id", "rs")


def test_first_flags_with_null_order_value(spark):
    df = spark.createDataFrame([(1, None, 10), (1, 5, 11), (2, 3, 12)], "g long, t long, id long")
    out = windows.first_flags(df, ["g"], ["t", "id"])
    assert rows(out, "id", "is_first") == [(10, True), (11, False), (12, True)]


def test_first_valid_keeps_rows_of_unknown_validity(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", True), (3, "a", False), (4, None, True), (5, None, True)], "seq long, k string, ok boolean")
    out = windows.first_valid(df, ["k"], ["seq"], F.col("ok"))
    assert rows(out, "seq", "registered", "reason") == [(1, False, "not_numeric"), (2, True, "ok"), (3, False, "not_numeric"),
                                                        (4, True, "ok"), (5, False, "duplicate")]


def test_order_by_zoned_timestamps_across_dst(spark):
    # the wall clock repeats an hour at a fall-back change, the order does not
    from tessera.operators.ordering import order_value
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(i,) for i in range(6)], "i int").select(
            "i", F.to_utc_timestamp(F.lit("2024-11-03 05:00:00"), "UTC").alias("base"))
        df = df.select("i", (F.col("base") + F.make_dt_interval(F.lit(0), F.col("i") * 30)).alias("ts"))
        got = [r["m"] for r in df.select("i", order_value(df, ["ts"]).alias("m")).orderBy("i").collect()]
        assert got == sorted(got) and len(set(got)) == len(got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_segmented_counters_and_parity_on_events(spark):
    # thresholds small enough that most users / days are cut into chunks
    e = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    seg = Segments(chunk_rows=10)
    targets = ["signup", "purchase", "view"]
    order = ["ts", "event_id"]
    a = windows.running_counters(e, ["user_id"], "event_type", order, targets, segments=seg)
    b = windows.running_counters(e, ["user_id"], "event_type", order, targets)
    cols = ("event_id", "step", "n_new", "n_miss")
    assert rows(a, *cols) == rows(b, *cols)
    day = e.withColumn("day", F.to_date("ts"))
    claimed = windows.first_claims(day, ["event_type", "day"], order)
    p1 = windows.turn_parity(claimed, ["day"], order, "accepted", segments=seg)
    p2 = windows.turn_parity(claimed, ["day"], order, "accepted")
    assert rows(p1, "event_id", "accepted_before", "player") == rows(p2, "event_id", "accepted_before", "player")
    p3 = windows.claimed_turns(day, ["day"], ["event_type"], order)
    assert rows(p3, "event_id", "accepted", "accepted_before", "player") == rows(p2, "event_id", "accepted", "accepted_before", "player")


def test_claimed_turns_of_missing_keys(spark):
    data = [(None, None, 1), (None, "a", 2), (None, None, 3), (1, "a", 4), (1, "a", 5), (1, "b", 6), (1, "c", 7)]
    got = rows(windows.claimed_turns(spark.createDataFrame(data, "g int, s string, k int"), ["g"], ["s"], ["k"], players=("1", "2", "3")),
               "k", "accepted", "accepted_before", "player")
    assert got == [(1, True, 0, "1"), (2, True, 1, "2"), (3, False, 2, "3"), (4, True, 0, "1"), (5, False, 1, "2"), (6, True, 1, "2"), (7, True, 2, "3")]


@pytest.mark.parametrize("targets,budget", [(["a", "b", "c"], 2), (["a", "a", "z"], 1), ([], 3), (["b"], 0), (["a", "b", "c", "d"], 30)])
def test_coverage_replay_equals_a_loop(spark, targets, budget):
    """Sessions of any length (one holds a third of all rows), missing sessions and values."""
    rnd = random.Random(len(targets))
    data = [(None if k % 17 == 0 else "hot" if k % 3 == 0 else f"s{rnd.randrange(60)}", k, rnd.choice("abcdefgh") if k % 13 else None) for k in range(900)]
    want = {}
    for name in {r[0] for r in data}:
        mine, seen, covered, spent, misses = [r[2] for r in data if r[0] == name], set(), None, None, 0
        for step, v in enumerate(mine, 1):
            if v is None or v in seen:
                continue
            seen.add(v)
            if v in targets:
                covered = step if covered is None and set(targets) <= seen else covered
            else:
                misses += 1
                spent = step if misses == budget else spent
        outcome = "covered" if covered and (spent is None or covered < spent) else "exhausted" if spent else "unfinished"
        want[name] = (covered, spent, outcome, min([x for x in (covered, spent) if x] or [len(mine)]), len(set(targets)))
    df = spark.createDataFrame(data, "s string, k int, v string").repartition(4)
    assert {r[0]: tuple(r[1:]) for r in windows.coverage_replay(df, ["s"], "v", ["k"], targets, budget).collect()} == want


def test_cuts_of_a_large_key_are_bounded(spark):
    """60,000 rows of one key at 100 rows a chunk would be 600 chunks; 20 are allowed, of even size, and sums stay exact."""
    df = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v")).repartition(6)
    for most in (20, 1024):
        seg = Segments(chunk_rows=100, max_chunks=most)
        sizes = [r["count"] for r in windows._with_chunk(df, ["k"], ["t"], seg).groupBy("_chunk").count().collect()]
        if most == 20:
            assert 15 <= len(sizes) <= 21 and max(sizes) < 2.2 * 60_000 / len(sizes)
        else:
            assert 500 < len(sizes) < 700 and max(sizes) < 300
    got = windows.running_sums(df, ["k"], ["t"], {"s": F.col("v")}, segments=Segments(chunk_rows=100, max_chunks=20))
    want = windows.running_sums(df, ["k"], ["t"], {"s": F.col("v")})
    assert got.select("t", "s").exceptAll(want.select("t", "s")).count() == 0 and got.count() == 60_000

from conftest import rows
from fixtures import BIRTHDAYS, LIST_A, LIST_A2, LIST_B, LIST_B2, ORDERED_MIXED, PROBES, SQUARES, happy_lines, prime_lines
from pyspark.sql import functions as F

from tessera.functions.strings import normalise_key
from tessera.operators import relational
from tessera.sources import cards


def _list(spark, values, name="v", typ="bigint"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"pos int, {name} {typ}")


def test_list_overlap(spark):
    a = _list(spark, LIST_A).select("v")
    b = _list(spark, LIST_B).select("v")
    assert rows(relational.intersect_distinct(a, b)) == [(x,) for x in [1, 2, 3, 5, 8, 13]]
    assert rows(relational.double_except(a, b)) == rows(relational.double_except_literal(a, b))
    semi = rows(relational.semi_join(a, b, "v"))
    assert semi == [(x,) for x in [1, 1, 2, 3, 5, 5, 8, 13]]
    assert rows(relational.except_distinct(a, b)) == [(x,) for x in [21, 34, 55, 89]]


def test_double_except_plan_is_one_intersect(spark):
    a = _list(spark, LIST_A).select("v")
    b = _list(spark, LIST_B).select("v")
    plan = relational.double_except(a, b)._jdf.queryExecution().optimizedPlan().toString()
    literal = relational.double_except_literal(a, b)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and "LeftAnti" not in plan
    assert literal.count("LeftAnti") == 2


def test_file_overlap_text_vs_integers(spark):
    primes = spark.createDataFrame([(p,) for p in prime_lines()], "value string")
    happy = spark.createDataFrame([(h,) for h in happy_lines()], "value string")
    as_text = relational.intersect_distinct(primes, happy)
    assert as_text.count() == 33
    ints_p = primes.select(F.trim("value").cast("bigint").alias("v"))
    ints_h = happy.select(F.trim("value").cast("bigint").alias("v"))
    assert relational.intersect_distinct(ints_p, ints_h).count() == 35
    # two ways of computing the overlap agree (the reference's own check)
    report = relational.overlap_report(relational.intersect_distinct(ints_p, ints_h),
                                       relational.semi_join(ints_p, ints_h, "v")).first()
    assert (report["only_first"], report["only_second"], report["n_first"]) == (0, 0, 35)


def test_filters(spark):
    sq = _list(spark, SQUARES)
    assert rows(relational.keep_even(sq, "v"), "v") == [(4,), (16,), (36,), (64,), (100,)]
    assert rows(relational.keep_below(sq, "v", 10), "v") == [(1,), (4,), (9,)]
    assert rows(relational.keep_in(sq, "v", [4, 9], negate=True), "v")[:2] == [(1,), (16,)]


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1)], "k string, n int")
    assert rows(relational.repeat_rows(df, "n"), "k", "rep") == [("a", 1), ("a", 2), ("a", 3), ("c", 1)]


def test_lookup_keeps_misses(spark):
    dim = spark.createDataFrame(BIRTHDAYS, "name string, birthday string")
    asks = spark.createDataFrame([("  ewa ",), ("Jan",), ("ARTUR",)], "ask string")
    out = relational.lookup(asks.withColumn("key", normalise_key(F.col("ask"))), dim, "key", "name", ["birthday"])
    got = rows(out, "key", "birthday", "found")
    assert got == [("Artur", "1980-03-14", True), ("Ewa", "1988-04-13", True), ("Jan", "not found", False)]


def test_deck_product_and_first_five(spark):
    ranks = spark.createDataFrame([(i, r) for i, r in enumerate(cards.RANKS)], "rank_no int, rank string")
    deck = relational.with_each(ranks, "suit", cards.SUITS, position="suit_no")
    assert deck.count() == 52
    first = deck.orderBy("rank_no", "suit_no").limit(5).collect()
    assert [f"{r['rank']} of {r['suit']}" for r in first] == [
        "Two of Hearts", "Two of Diamonds", "Two of Spades", "Two of Clubs", "Three of Hearts"]


def test_presence_probes(spark):
    data = spark.createDataFrame([(float(v),) for v in ORDERED_MIXED], "v double")
    probes = spark.createDataFrame([(float(p),) for p in PROBES], "p double")
    got = dict(rows(relational.presence(probes, "p", data, "v"), "p", "found"))
    assert got == {0.0: False, 1.0: True, 2.0: True, 3.0: True, 4.0: True, 5.5: True, 6.0: True, 7.0: False,
                   8.0: True, 9.0: True, 10.0: False}


def test_distinct_semi(spark):
    a = _list(spark, LIST_A2).select("v")
    b = _list(spark, LIST_B2).select("v")
    assert rows(relational.distinct_semi(a, b, "v")) == [(x,) for x in [1, 2, 3, 5, 8, 13]]

"""Missing, broken, late and repeated input: no row is lost, none is wrong."""

import os
import time
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera import streaming as stream
from tessera.functions import numbers, strings
from tessera.operators import aggregates, folds, sampling
from tessera.sources import html, parse, text
from tessera.sources import json as jsn

EVENTS = "acct long, seq long, kind string, amount long"


def _ledger(df, **more):
    return folds.ledger(df, "acct", ["seq"], "kind", F.col("amount"), ["in"], ["out"], **more)


def test_repeated_rows_with_null_keys_are_kept(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert rows(aggregates.occurrence_split(df, ["k"])) == [(1, 2, "repeated"), (1, 2, "repeated"), (2, 1, "single"),
                                                            (None, 2, "repeated"), (None, 2, "repeated")]


def test_ledger_with_null_amounts_and_accounts(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, 1, "in", 100), (big, 2, "in", None), (None, 3, "in", 50), (None, 4, "out", 20),
                                (big, 5, "out", None), (big, 6, "out", 30), (big, 7, "in", -5)], EVENTS)
    assert rows(_ledger(df)) == [(big, 70, 1, 1, 3, 5), (None, 30, 1, 1, 0, 0)]
    per = _ledger(df, event_id="seq", per_event=True)
    assert rows(per, "event_id", "accepted", "balance_after", "reason") == [
        (1, True, 100, "ok"), (2, False, 100, "no_amount"), (3, True, 50, "ok"), (4, True, 30, "ok"),
        (5, False, 100, "no_amount"), (6, True, 70, "ok"), (7, False, 70, "negative")]


@pytest.mark.parametrize("key_type", ["string", "date"])
def test_ledger_accounts_of_other_types(spark, key_type):
    df = spark.createDataFrame([("2024-01-01", 1, "in", 5), ("2024-01-02", 2, "out", 5), ("2024-01-01", 3, "out", 9)],
                               "acct string, seq long, kind string, amount long")
    got = _ledger(df.withColumn("acct", F.col("acct").cast(key_type))).withColumn("acct", F.col("acct").cast("string"))
    assert rows(got) == [("2024-01-01", 5, 1, 0, 1, 9), ("2024-01-02", 0, 0, 0, 1, 5)]


def test_many_rejections_and_many_accounts_are_fast():
    n = 200_000
    amount, yes = np.full(n, 10, np.int64), np.ones(n, bool)
    for starts in (np.array([0]), np.arange(n)):
        began = time.perf_counter()
        accepted, after = folds.walk_batch(starts, amount, yes, yes, np.zeros(len(starts), np.int64))
        assert time.perf_counter() - began < 2 and not accepted.any() and not after.any()


def _events(spark, folder, name, rows_):
    df = spark.createDataFrame(rows_, EVENTS)
    path = os.path.join(folder, f"_{name}")
    df.coalesce(1).write.parquet(path)
    source = next(f for f in os.listdir(path) if f.startswith("part-"))
    os.makedirs(os.path.join(folder, "table"), exist_ok=True)
    target = os.path.join(folder, "table", f"{name}.parquet")
    os.link(os.path.join(path, source), target)
    os.utime(target, (1_700_000_000 + int(name),) * 2)  # files are read oldest first


def _streamed(spark, source, **more):
    return stream.stream_ledger(spark, source, EVENTS, "acct", ["seq"], "kind", "amount", ["in"], ["out"], **more)


def test_streams_over_a_file_and_a_folder_of_parts(spark, scratch):
    data = [(k % 7 if k % 7 else None, k, "out" if k % 3 == 0 else "in", k % 11) for k in range(200)]
    df = spark.createDataFrame(data, EVENTS)
    df.repartition(5).write.parquet(f"{scratch}/events.parquet")
    want = rows(_ledger(df))
    assert rows(_streamed(spark, f"{scratch}/events.parquet").drop("n_late")) == want
    counts = stream.stream_counts(spark, f"{scratch}/events.parquet", EVENTS, "kind", files_per_trigger=2)
    assert rows(counts) == rows(df.groupBy("kind").count())
    _events(spark, f"{scratch}", "1", data)
    assert rows(_streamed(spark, f"{scratch}/table/1.parquet").drop("n_late")) == want
    assert rows(stream.stream_counts(spark, f"{scratch}/table/1.parquet", EVENTS, "kind")) == rows(df.groupBy("kind").count())


def test_micro_batches_in_order_equal_the_batch_fold(spark, scratch):
    data = [(k % 5, k, "out" if k % 3 == 0 else "in", k % 13) for k in range(120)]
    for b in range(4):
        _events(spark, scratch, str(b), data[b * 30:(b + 1) * 30])
    out = _streamed(spark, f"{scratch}/table", files_per_trigger=1)
    assert rows(out.drop("n_late")) == rows(_ledger(spark.createDataFrame(data, EVENTS)))
    assert out.agg(F.sum("n_late")).first()[0] == 0 and out.late_events.count() == 0


def test_late_events_are_rejected_and_counted(spark, scratch):
    _events(spark, scratch, "1", [(1, 10, "out", 5), (2, 11, "in", 7)])
    _events(spark, scratch, "2", [(1, 9, "in", 100), (2, 12, "out", 3), (3, 1, "in", 4)])  # account 1: before its last event
    out = _streamed(spark, f"{scratch}/table", files_per_trigger=1)
    assert rows(out, "acct", "balance", "n_rejected", "n_late") == [(1, 0, 1, 1), (2, 4, 0, 0), (3, 4, 0, 0)]
    assert rows(out.late_events, "acct", "seq") == [(1, 9)]


def test_json_reasons_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":2,"a":3}'), (2, "{bad"), (3, None), (4, "{}"), (5, "[1]"), (6, '{"x":null}')], "id long, js string")
    got = rows(jsn.json_entries(df, "js", ["id"], reason="reason"))
    assert sorted(got, key=str) == sorted([(1, "a", "3", "ok"), (1, "b", "2", "ok"), (2, None, None, "not_an_object"), (3, None, None, "no_text"),
                                           (4, None, None, "empty"), (5, None, None, "not_an_object"), (6, "x", None, "ok")], key=str)
    assert rows(jsn.json_entries(df, "js", ["id"])) == [(1, "a", "3"), (1, "b", "2"), (6, "x", None)]


def test_headings_in_difficult_pages():
    t = html.heading_texts
    assert t("<!-- <h1>old</h1> --><h1>new</h1>", "h1") == ["new"]
    assert t("<script>var x='<h1>no</h1>';</script><h1>yes</h1>", "h1") == ["yes"]
    assert t("<h1>&eacute;&#8217;&nbsp;&amp;lt;</h1>", "h1") == ["é’ &lt;"]
    assert t("<div class='a  big'>one</div><p class=big>two</p><p class=\"bigger\">no</p>", None, "big") == ["one", "two"]
    assert t("<div class='c'>out <div class='c'>in</div> more</div>", None, "c") == ["out", "in"]
    assert t("<h1>never closed", "h1") == [] and t("", "h1") == []
    assert t("<h1>x <a href=1>link\n<b>text</b></a> y</h1>", "h1") == ["link text"]


def test_headings_keep_pages_without(spark):
    df = spark.createDataFrame([(1, None), (2, "<p>"), (3, "<h1>a</h1><h1>b</h1>")], "id long, page string")
    assert rows(html.headings(df, "page", ["id"])) == [(1, None, None), (2, None, None), (3, 1, "a"), (3, 2, "b")]


def test_divisors_of_large_numbers(spark):
    n = 999_983 * 1_000_003  # two primes
    assert spark.createDataFrame([(n,)], "n long").select(numbers.divisors("n")).first()[0] == [1, 999_983, 1_000_003, n]


def test_divisors_in_blocks(spark):
    numbers_ = [1, 2, 3, 4, 97, 65_536**2, 65_537**2, 999_983 * 1_000_003, 2**40, 3**25, 360_360, 0, -4, None, 360_360, 10**15]
    got = {}
    for r in numbers.divisors_of(spark.createDataFrame([(n,) for n in numbers_], "n long"), "n").collect():
        got.setdefault(r["n"], []).append(r["divisor"])
    for n in {n for n in numbers_ if n and n > 0}:
        want, left, p = {1}, n, 2
        while left > 1:
            if p * p > left:
                p = left
            powers = [1]
            while left % p == 0:
                left //= p
                powers.append(powers[-1] * p)
            want = {w * q for w in want for q in powers}
            p += 1
        assert sorted(got.pop(n)) == sorted(want)
    assert got == {}


def test_fibonacci_terms_of_any_size(spark):
    asked = [None, -5, 0, 1, 2, 3, 43, 44, 92, 93, 182, 186, 187, 1000, 1000, 4999]
    terms = [0, 1]
    while len(terms) < 5000:
        terms.append(terms[-1] + terms[-2])
    got = numbers.fibonacci_of(spark.createDataFrame([(n,) for n in asked], "n int"), "n").collect()
    assert Counter(map(tuple, got)) == Counter((n, str(terms[n]) if n and n > 0 else None) for n in asked)



def test_strict_lines_fail_without_ansi_too(spark):
    df = spark.createDataFrame([(" 7 ",), ("x",)], "v string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not an integer: x"):
            text.typed_lines(df, "v").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_mask_and_needle_held_by_the_row(spark):
    df = spark.createDataFrame([("Hello", "el"), ("", "x"), ("abc", "")], "t string, s string")
    got = df.select(strings.mask_chars(F.col("t"), F.col("s")).alias("m"), strings.contains_text(F.col("t"), F.col("s")).alias("c"))
    assert [tuple(r) for r in got.collect()] == [("_ E L L _", True), ("", False), ("_ _ _", True)]


def test_random_element_breaks_ties_by_key(spark):
    df = spark.range(50).select(F.lit("g").alias("g"), F.col("id"), F.array(F.lit("a"), F.lit("b")).alias("w"))
    one = sampling.random_element(df.unionByName(df.limit(0)), ["g"], F.col("w"), ["id"], 1)
    assert rows(one)[0][1] in ("a", "b") and one.count() == 1
    none = spark.createDataFrame([("g", 1, [])], "g string, id long, w array<string>")
    assert sampling.random_element(none, ["g"], F.col("w"), ["id"], 1).count() == 0


def test_every_validation_reason(spark):
    df = spark.createDataFrame([("1", "x"), ("1,2,3", "-1"), ("a,1", "9"), ("0,1", "3"), ("8,1", "3"), ("2,3", "3")], "m string, a string")
    got = parse.move_fields(df, "m", "a").select(parse.move_reason_of(F.lit(7)), parse.amount_reason_of(F.lit(5))).collect()
    assert [tuple(r) for r in got] == [("too_few", "not_number"), ("too_many", "negative"), ("not_integer", "above_limit"),
                                       ("too_low", "ok"), ("too_high", "ok"), ("ok", "ok")]


def test_headings_equal_the_parser_on_every_page(spark):
    """The look at each page beforehand loses nothing: odd case, spaces, comments, quoted and escaped attributes, unclosed ends."""
    pages = ["<H1>a</H1>", "<h1\n class=x>b</h1 >", "<h1>c</h1", "<h1/>d</h1>", "<h10>e</h10>", "<!-- <h1>f</h1> --><h2>g</h2>", "<h1>h", "h</h1>",
             "<p class='b&#105;g'>i</p>", "<p class=\"a big\">j</p>", "<p class=bigger>k</p>", "<p title='<h1>'>l</h1></p>", "<script>'<h1>'</script></h1>", None, ""]
    df = spark.createDataFrame(list(enumerate(pages)), "id long, page string")
    for tag, css in (("h1", None), (None, "big")):
        want = []
        for i, p in enumerate(pages):
            found = html.heading_texts(p or "", tag, css)
            want += [(i, k + 1, t) for k, t in enumerate(found)] or [(i, None, None)]
        assert Counter(map(tuple, html.headings(df, "page", ["id"], tag, css).collect())) == Counter(want)

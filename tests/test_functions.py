import math

from conftest import rows
from pyspark.sql import functions as F

from tessera.functions import collections as coll
from tessera.functions import dates, numbers, strings


def _one(spark, values, typ, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_palindromes(spark):
    assert _one(spark, ["2kajak2", "Kobyła ma mały bok", "2kajak2!"], "string", strings.is_palindrome) == [
        True, True, False]


def test_fibonacci(spark):
    got = _one(spark, [-1, 0, 1, 2, 3, 4, 9, 92, 100], "int", numbers.fibonacci)
    assert got[:7] == [None, None, 1, 1, 2, 3, 34]
    a, b = 0, 1
    for _ in range(100):
        a, b = b, a + b
    assert int(got[8]) == a and int(got[7]) == 7540113804746346429


def test_fibonacci_terms(spark):
    got = _one(spark, [-1, 0, 1, 2, 3, 4, 9], "int", numbers.fibonacci_terms)
    assert [[int(v) for v in g] for g in got] == [[], [], [1], [1, 1], [1, 1, 2], [1, 1, 2, 3],
                                                   [1, 1, 2, 3, 5, 8, 13, 21, 34]]


def test_divisors_full_set(spark):
    got = _one(spark, [1, 2, 4, 9, 10, 36, 97, 0, -4], "int", numbers.divisors)
    assert [list(g) if g is not None else None for g in got] == [
        [1], [1, 2], [1, 2, 4], [1, 3, 9], [1, 2, 5, 10], [1, 2, 3, 4, 6, 9, 12, 18, 36], [1, 97], None, None]


def test_floor_mod_and_divmod_follow_python(spark):
    pairs = [(a, b) for a in (-7, -6, -1, 0, 1, 6, 7) for b in (-3, -2, 2, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", numbers.floor_mod("a", "b").alias("m"),
                    numbers.divmod_pair("a", "b").alias("d")).collect()
    for r in got:
        assert r["m"] == r["a"] % r["b"]
        assert (r["d"]["quotient"], r["d"]["remainder"]) == divmod(r["a"], r["b"])
    zero = spark.createDataFrame([(5, 0)], "a long, b long").select(numbers.floor_mod("a", "b")).first()[0]
    assert zero is None


def test_rounding_half_even(spark):
    got = _one(spark, [0.5, 1.5, 2.5, -0.5, -1.5, 2.4], "double", lambda c: numbers.round_half_even(c))
    assert got == [round(x) for x in [0.5, 1.5, 2.5, -0.5, -1.5, 2.4]]


def test_number_class(spark):
    got = _one(spark, [8.0, 6.0, 9.0, 7.0, 0.0, 2.5], "double", lambda c: numbers.number_class(c, 3))
    assert got == ["multiple_of_4", "even", "multiple_of_divisor", "odd", "multiple_of_4", "not_integer"]


def test_title_strip_and_split_follow_python(spark):
    samples = ["o'neil", "hello world", "HOUSEHOLD", "x-ray 2nd", "", "  padded\t\n", "ΑΒΓ δέλτα", "a b",
               "ΟΔΟΣ", "AΣ'B", "ΣΣ", "straße", "ǆungla"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select("s", strings.title_case("s").alias("t"), strings.py_strip("s").alias("p"),
                    strings.split_whitespace("s").alias("w")).collect()
    for r in got:
        assert r["t"] == r["s"].title(), r["s"]
        assert r["p"] == r["s"].strip(), r["s"]
        assert list(r["w"]) == r["s"].split(), r["s"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Two of Hearts", "EVA", 3)], "card string, w string, n int")
    r = df.select(strings.substring_before("card", " of ").alias("rank"),
                  strings.first_char_lower("card").alias("c"),
                  strings.contains_text("card", "hear").alias("has"),
                  strings.repeat_text(F.lit("-"), "n").alias("bar"),
                  strings.repeat_text(F.lit("-"), F.lit(-2)).alias("none"),
                  strings.mask_chars("w", ["e", "a"]).alias("mask"),
                  strings.slice_both_ends("card", 3, 4).alias("sl"),
                  strings.distinct_char_count("card").alias("dc")).first()
    assert r["rank"] == "Two" and r["c"] == "t" and r["has"] is True
    assert r["bar"] == "---" and r["none"] == ""
    assert r["mask"] == "E _ A"
    assert r["sl"] == "Two of Hearts"[3:-4]
    assert r["dc"] == len(set("Two of Hearts"))


def test_year_at_age_and_dates(spark):
    df = spark.createDataFrame([(30, "2024-06-01", "1988-04-13"), (40, "2024-01-01", "not a date")],
                               "age int, asof string, d string")
    got = df.select(numbers.year_at_age("age", "asof").alias("y"), dates.iso_date("d").alias("dd")).collect()
    assert [r["y"] for r in got] == [2094, 2084]
    assert str(got[0]["dd"]) == "1988-04-13" and got[1]["dd"] is None
    assert spark.range(1).select(dates.current_year()).first()[0] >= 2024


def test_list_ends_and_maps(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6],), ([],)], "a array<bigint>")
    got = df.select(coll.first_item("a").alias("f"), coll.last_item("a").alias("l")).collect()
    assert [(r["f"], r["l"]) for r in got] == [(1, 6), (None, None)]
    m = spark.createDataFrame([({"Ewa": "1988-04-13"},)], "m map<string,string>")
    r = m.select(coll.map_get("m", "Ewa").alias("hit"), coll.map_get("m", "Jan").alias("miss"),
                 coll.map_has("m", "Ewa").alias("has")).first()
    assert (r["hit"], r["miss"], r["has"]) == ("1988-04-13", None, True)
    nested = spark.createDataFrame([([[1, 2], [3, 4]],)], "m array<array<int>>")
    assert nested.select(coll.nested_item("m", 1, 0), coll.nested_item("m", 5, 0)).first()[:] == (3, None)


def test_clamp_and_cents(spark):
    df = spark.createDataFrame([(10, 19.99), (3, -0.015)], "n int, x double")
    assert rows(df.select(numbers.clamp("n", hi=6).alias("c"), numbers.to_cents("x").alias("ct"))) == [
        (3, -2), (6, 1999)]
    assert math.isclose(19.99 * 100, 1999, rel_tol=1e-9)


def test_per_character_functions_are_linear(spark):
    # a lambda that indexed an outer array would rebuild it per character
    # (quadratic); 40 texts of 20,000 characters must take well under a minute
    import time
    text = ("word O'neil ΟΔΟΣ x-ray " * 900)[:20000]
    df = spark.createDataFrame([(i, text) for i in range(40)], "i int, t string")
    t0 = time.perf_counter()
    out = df.select(strings.title_case("t").alias("a"), strings.mask_chars("t", ["a", "e"]).alias("b"),
                    strings.distinct_char_count("t").alias("c")).collect()
    assert time.perf_counter() - t0 < 60
    assert out[0]["a"] == text.title()

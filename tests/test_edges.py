"""Empty, all-invalid and single-row inputs for each parse and fold, and
Python-equivalence properties of the string and number helpers."""

import string

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import numbers, strings
from tessera.operators import aggregates as agg
from tessera.operators import folds, windows
from tessera.sources import parse, text

EVENT_SCHEMA = "session long, step long, v string"


def test_empty_inputs(spark):
    empty_text = spark.createDataFrame([], "id long, t string")
    assert text.lines_of(empty_text, "t", ["id"]).count() == 0
    assert text.word_list(empty_text, "t", ["id"]).count() == 0
    ev = spark.createDataFrame([], EVENT_SCHEMA)
    assert windows.coverage_replay(ev, ["session"], "v", ["step"], ["a"], 1).count() == 0
    assert windows.running_counters(ev, ["session"], "v", ["step"], ["a"],
                                    segments=windows.Segments(chunk_rows=10)).count() == 0
    cards = spark.createDataFrame([], "hand long, v int")
    assert folds.hand_values(cards, ["hand"], F.col("v"), F.lit(False)).count() == 0
    assert agg.value_counts(spark.createDataFrame([], "pos long, x string"), "x", ["pos"]).count() == 0


def test_all_invalid_and_single_row(spark):
    bad = spark.createDataFrame([("a,b",), ("",), (" , ",)], "t string")
    parsed = bad.withColumn("vals", parse.int_list(F.col("t"))).withColumn("is_valid",
                                                                          parse.int_list_valid(F.col("vals")))
    ok, rejected = parse.split_rejects(parsed)
    assert ok.count() == 0 and rejected.count() == 3
    one = spark.createDataFrame([("acct", 1, "withdraw", 5)], "acct string, seq long, kind string, amount long")
    out = folds.ledger(one, "acct", ["seq"], "kind", F.col("amount"), ["deposit"], ["withdraw"])
    assert rows(out) == [("acct", 0, 0, 0, 1, 5)]
    single = spark.createDataFrame([(1, 1, "a")], EVENT_SCHEMA)
    r = windows.coverage_replay(single, ["session"], "v", ["step"], ["a"], 1).first()
    assert (r["covered_step"], r["outcome"], r["steps_used"]) == (1, "covered", 1)


TEXTS = st.lists(st.text(alphabet=string.ascii_letters + " \t\n\r\x0b\x0c\x1c\x85\xa0 ßéΣ'-ﬁǅǆİıςσ́აԵև.·:", max_size=30),
                 min_size=1, max_size=60)


@settings(max_examples=25, deadline=None, derandomize=True)
@given(TEXTS)
def test_string_helpers_follow_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", strings.split_lines("t").alias("lines"), strings.py_strip("t").alias("strip"),
                    strings.split_whitespace("t").alias("words"), strings.title_case("t").alias("title")).collect()
    for r in got:
        t = texts[r["i"]]
        assert list(r["lines"]) == t.splitlines(), repr(t)
        assert r["strip"] == t.strip(), repr(t)
        assert list(r["words"]) == t.split(), repr(t)
        assert r["title"] == t.title(), repr(t)


@settings(max_examples=25, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-1000, 1000)), min_size=1, max_size=60))
def test_floor_arithmetic_follows_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", numbers.floor_mod("a", "b").alias("m"), numbers.floor_div("a", "b").alias("q")).collect():
        if r["b"] == 0:
            assert r["m"] is None and r["q"] is None
        else:
            assert (r["q"], r["m"]) == divmod(r["a"], r["b"])


def test_partition_settings():
    from tessera.session import partition_settings
    big = partition_settings(100 * 2 ** 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "409600"
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 4 * (256 << 20)
    assert partition_settings(10 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def _py_word_list(t: str):
    words = [w.strip() for w in t.splitlines()]
    first_blank = next((i for i, w in enumerate(words) if w == ""), None)
    return [(i + 1, w, first_blank is None or i < first_blank) for i, w in enumerate(words) if w != ""]


@settings(max_examples=25, deadline=None, derandomize=True)
@given(TEXTS)
def test_word_list_follows_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {}
    for r in text.word_list(df, "t", ["i"]).collect():
        got.setdefault(r["i"], []).append((r["line_no"], r["word"], r["before_blank"]))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == _py_word_list(t), repr(t)

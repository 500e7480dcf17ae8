"""Fill-in-middle against slices of Python strings."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm.fill_middle import BLOCK, MARKERS, fill_in_middle, restored, unit_count
from tessera.llm.queries import QUERIES

from .conftest import SF01


def model(doc_id, text, seed="1", moved=90, spm=20, markers=MARKERS, units=list):
    """(n, form, prefix units, middle units, output) as the contract has it."""
    text = text or ""
    parts = units(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in markers) or h[2] % 100 >= moved:
        return n, "plain", None, None, text
    prefix, middle = "".join(parts[:a]), "".join(parts[a:b])
    suffix = text[len(prefix) + len(middle):]
    p, s, m = markers
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def check(frame, **options):
    keys = {k: v for k, v in options.items() if k in ("seed", "unit", "markers")}
    out = fill_in_middle(frame, moved_percent=options.get("moved", 90), spm_percent=options.get("spm", 20), **keys)
    out = out.withColumn("back", restored(F.col("output"), F.col("form"), options.get("markers", MARKERS)))
    rows = out.collect()
    plain = {k: v for k, v in options.items() if k != "unit"}
    for r in rows:
        got = (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
        assert got == model(r["doc_id"], r["text"], **plain)
        assert r["back"] == (r["text"] or "")
    return rows


def test_edges(spark, edges, nothing):
    frame = edges.withColumn("output", F.lit("mine")).withColumn("N", F.lit("mine"))
    rows = check(frame.drop("N"))
    assert len(rows) == edges.count()
    assert fill_in_middle(frame).columns.count("n") == 1 and "N" not in fill_in_middle(frame).columns
    assert fill_in_middle(nothing).collect() == []


def test_query_equals_the_model(spark, docs01):
    for r in QUERIES["op11_fill_middle"](spark, SF01).collect():
        n, form, prefix, middle, output = model(r["doc_id"], docs01[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(docs01[r["doc_id"]].encode()).hexdigest()


def test_blocks_and_astral_characters(spark):
    sizes = [1, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK, 5 * BLOCK + 7, 1_000_000]
    texts = [(k, "😀é\n$\\"[k % 5] * n) for k, n in enumerate(sizes)] + [(99, "a b\r\nc\u0085d")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["doc_id"]: r["n"] for r in check(frame, moved=100)} == {k: len(t) for k, t in texts}


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(st.one_of(st.sampled_from("<>PSM$\\{} \n"), st.characters(codec="utf-8", exclude_characters="\0")), max_size=30), min_size=1, max_size=40),
       seed=st.sampled_from(["1", "other"]), spm=st.sampled_from([0, 50, 100]))
def test_odd_texts(spark, texts, seed, spm):
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), seed=seed, spm=spm, moved=100)


def test_texts_with_markers_stay(spark):
    rows = check(spark.createDataFrame([(k, t) for k, t in enumerate(["a<P>b", "<S>", "x<M", "M>", "<<S", "P><"])], "doc_id long, text string"), moved=100)
    assert [r["form"] == "plain" for r in sorted(rows, key=lambda r: r["doc_id"])] == [True, True, False, False, False, False]


def test_other_units_and_markers(spark):
    texts = [(k, t) for k, t in enumerate(["one two  three four ", "  lead", "word", "a b c d e f g h " * 600, " "])]
    words = lambda t: re.findall(r"\s*\S+", t)
    check(spark.createDataFrame(texts, "doc_id long, text string"), unit=r"\s*+\S++", moved=100, units=words)
    check(spark.createDataFrame(texts, "doc_id long, text string"), moved=100, markers=("$1", "\\\\".replace("\\\\", "\\q"), "[x"))
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            restored(F.col("a"), F.col("b"), bad)


def test_plan_is_one_pass_without_python(spark):
    frame = spark.read.parquet(f"{SF01}/documents.parquet")
    plan = fill_in_middle(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert frame.limit(1).select(unit_count(F.lit(None).cast("string"))).first()[0] is None

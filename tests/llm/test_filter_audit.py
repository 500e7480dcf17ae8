"""Filter interactions against sets and loops."""

import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import filter_audit as fa
from tessera.llm.queries import QUERIES

from .conftest import SF01

SORTED = st.lists(st.integers(0, 3000), unique=True, max_size=1500).map(sorted).map(lambda x: np.array(x, np.int64))


@settings(max_examples=150, deadline=None)
@given(st.lists(SORTED, min_size=1, max_size=4))
def test_merges_equal_sets(lists):
    sets = [set(x.tolist()) for x in lists]
    assert fa.union(lists).tolist() == sorted(set().union(*sets))
    a, b = lists[0], lists[-1]
    assert fa.gallop(a, b).tolist() == np.searchsorted(a, b).tolist()
    assert fa.difference(a, b).tolist() == sorted(sets[0] - sets[-1])
    assert fa.common(a, b) == len(sets[0] & sets[-1])


def loop(rows, names, n_lost):
    """rows of (part, {filter: fails}, [flags]) -> the audit's rows, by applying the filters one by one."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                alone = [r for r in mine if r[1][f] and sum(r[1].values()) == 1]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(r[1][f] for r in mine) - len(gone), len(alone),
                                                   *[sum(r[2][g] for r in gone) for g in range(n_lost)]]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def found(frame, lost):
    keys = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[k] for k in keys] for r in frame.collect()}


@pytest.mark.parametrize("k,n,block_rows", [(1, 40, 7), (3, 400, 16), (5, 900, 64), (4, 300, 1 << 16)])
def test_audit_equals_a_loop(spark, k, n, block_rows):
    names, rng = "ABCDE"[:k], np.random.default_rng(k)
    rows = [(None if i % 11 == 0 else "hot" if i % 3 == 0 else f"p{i % 4}", *(bool(x) for x in rng.random(k + 2) < 0.3)) for i in range(n)]
    frame = spark.createDataFrame(rows, "p string, " + ", ".join(f"`{c}` boolean" for c in [*names, "good", "bad"])).repartition(5)
    got = found(fa.filter_audit(frame, F.col("p"), {c: F.col(c) for c in names}, {"good": F.col("good"), "bad": F.col("bad")}, block_rows),
                ["good", "bad"])
    assert got == loop([(r[0], dict(zip(names, r[1:], strict=False)), r[k + 1:]) for r in rows], names, 2)


def test_audit_edges(spark):
    empty = spark.createDataFrame([], "p string, a boolean")
    assert fa.filter_audit(empty, F.col("p"), {"A": F.col("a")}, {}).collect() == []
    nulls = spark.createDataFrame([("x", None), ("x", True)], "p string, a boolean")
    assert found(fa.filter_audit(nulls, F.col("p"), {"A": F.col("a")}, {}), []) == {("x", "A", 1): [1, 1, 0, 1, 1]}
    with pytest.raises(ValueError):
        fa.filter_audit(empty, F.col("p"), {c: F.col("a") for c in "ABCDEFG"}, {})


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}


def smaller(rows):
    """Is there a row with equal text and a smaller id?  (null ids come last)"""
    first = {}
    for i, t in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    return [t in first and (i is None or i > first[t]) for i, t in rows]


def test_query_equals_a_loop(spark):
    docs = [(r["doc_id"], r["text"] or "", r["source"] or "") for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    labels = {r["doc_id"]: (r["quality"] == 1, r["toxic"] == 1) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    copies = smaller([(i, t) for i, t, _ in docs])
    rows = [(s, contract(i, t) | {"E": e}, labels.get(i, (False, False))) for (i, t, s), e in zip(docs, copies, strict=True)]
    got = QUERIES["op13_filter_audit"](spark, SF01)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert found(got, ["good_lost", "toxic_lost"]) == loop(rows, "ABCDE", 2)


def test_marks_of_edge_rows(spark, edges, nothing):
    rows = fa.text_features(edges, carry={"text_": F.coalesce("text", F.lit(""))})
    for hot in (1, 1000):  # every group is looked up by one way or the other
        got = fa.mark_copies(rows, hot_groups=hot).collect()
        assert len(got) == edges.count()
        want = smaller([(r["doc_id"], r["text_"]) for r in got])
        assert [r["is_copy"] for r in got] == want
    for r in got:
        assert (r["n_words"] < 50, r["has_sign"]) == tuple(contract(0, r["text_"])[c] for c in "AD")
        assert (r["n_upper"], r["n_points"]) == (len(re.findall("[A-Z]", r["text_"])), len(r["text_"]))
        assert r["n_distinct"] == len(set(re.findall(r"[^\x20\x09-\x0d]+", r["text_"])))
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    marked = fa.mark_labels(rows.withColumn("good", F.lit("mine")), labels, {"good": F.col("quality") == 1})
    assert marked.columns.count("good") == 1 and marked.count() == edges.count()
    assert all(r["good"] == (r["doc_id"] == 3) for r in marked.collect())
    assert fa.mark_labels(fa.mark_copies(fa.text_features(nothing)), labels, {"good": F.col("quality") == 1}).collect() == []
